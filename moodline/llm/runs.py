"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends
keeping q. Its words behind the first q are repetition, and ``collapse`` leaves them out.

The suffix automaton of a text has a state for each class of substrings that end at the same places;
its suffix links form a tree. For each word in turn, the path from the state of the text so far up to
the root holds all substrings that end here, the longest first. Access in a link-cut tree makes it one
preferred path, of which the segments are splay trees, and colours it with this place. A segment met
on the way up still has the place j where its substrings ended last. If its longest substring, of
length L, is at least as long as the distance d = i - j, the two occurrences touch: a square of period
d whose stretch starts at i - L - d + 1. That start is the leftmost there is, and d is the smallest
period of the stretch; at the run's last word i the stretch is the whole run. So keeping the last i of
each (start, d) extends squares to runs.

Only words that can belong to a run go through the automaton. Half of a run's words or more begin
grams that occur again; a text is cut at words that no repeated gram covers, and each piece is handled
by itself. A run with its neighbours lies in one piece, so this changes no result.

Null and empty texts have no words and no runs; a null id counts as empty text where it is hashed;
rows are handled each on its own, so repeated rows give equal rows; an empty table gives an empty
result; other columns are not looked at. A text's cost grows with n log n, however long it is and
whatever it repeats; it is worked on by one task, which holds some 300 bytes for each word in a piece.
Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

LEAST = 24  # words of a run
TIMES = 3  # periods of a run

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Automaton:
    """Suffix automaton of a sequence of integers: lengths, suffix links, the state of each prefix.

    Most states have one way on; it is kept in two lists, and a dictionary only for states with more.
    """

    def __init__(self, word: Sequence[int]):
        n = len(word)
        length, link = [0] * (2 * n + 1), [-1] * (2 * n + 1)
        label, target = [-1] * (2 * n + 1), [0] * (2 * n + 1)
        more: dict[int, dict[int, int]] = {}
        prefix = [0] * n
        size, last = 1, 0
        for i, c in enumerate(word):
            new = size
            size += 1
            length[new] = i + 1
            p = last
            while p >= 0:
                if label[p] == c or (p in more and c in more[p]):
                    break
                if label[p] < 0:
                    label[p], target[p] = c, new
                else:
                    more.setdefault(p, {})[c] = new
                p = link[p]
            if p < 0:
                link[new] = 0
            else:
                q = target[p] if label[p] == c else more[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = size
                    size += 1
                    length[twin] = length[p] + 1
                    link[twin] = link[q]
                    label[twin], target[twin] = label[q], target[q]
                    if q in more:
                        more[twin] = dict(more[q])
                    link[q] = link[new] = twin
                    while p >= 0:
                        if label[p] == c:
                            if target[p] != q:
                                break
                            target[p] = twin
                        else:
                            ways = more.get(p)
                            if ways is None or ways.get(c) != q:
                                break
                            ways[c] = twin
                        p = link[p]
            prefix[i] = last = new
        self.length, self.link, self.prefix = length[:size], link[:size], prefix


def _rotate(x: int, left: list[int], right: list[int], above: list[int], colour: list[int]) -> None:
    """Lift ``x`` over its parent within a splay tree; a root hands on its colour."""
    p = above[x]
    g = above[p]
    colour[x] = colour[p]
    if left[p] == x:
        child = right[x]
        left[p], right[x] = child, p
    else:
        child = left[x]
        right[p], left[x] = child, p
    if child >= 0:
        above[child] = p
    above[p], above[x] = x, g
    if g >= 0:
        if left[g] == p:
            left[g] = x
        elif right[g] == p:
            right[g] = x


def runs_of(word: Sequence[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs with ``length >= max(least, times * period)``.

    ``times`` is 2 at least. In order of start, then period.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    if len(word) < max(least, times):
        return []
    states = Automaton(word)
    length, size = states.length, len(states.length)
    above = states.link  # of a splay tree's root: the node its path hangs on
    left, right = [-1] * size, [-1] * size
    colour = [-1] * size  # of a splay tree's root: where the path's substrings ended last
    found: dict[tuple[int, int], int] = {}
    for i, state in enumerate(states.prefix):
        node, below = state, -1
        while node >= 0:
            # splay ``node`` to the root of its path's tree
            p = above[node]
            while p >= 0 and (left[p] == node or right[p] == node):
                g = above[p]
                if g >= 0 and (left[g] == p or right[g] == p):
                    _rotate(p if (left[g] == p) == (left[p] == node) else node, left, right, above, colour)
                _rotate(node, left, right, above, colour)
                p = above[node]
            j = colour[node]
            rest = right[node]
            if rest >= 0:  # the path below keeps its colour
                colour[rest] = j
            if j >= 0:
                d = i - j
                reach = length[node] + d
                if reach >= times * d and reach >= least:
                    found[i - reach + 1, d] = i
            right[node] = below
            below, node = node, above[node]
        # the whole path is one tree now; ``below`` is its root
        colour[below] = i
    return [(s, e - s + 1, d) for (s, d), e in sorted(found.items())]


def covered(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Which words may lie in a run: those in a gram that occurs twice.

    All but the last period of a run is met again one period later: at least
    ``least * (times - 1) / times`` words in a row, so grams of that size cover the run.
    """
    size = max(1, least * (times - 1) // times)
    n = len(ids)
    out = np.zeros(n, bool)
    if n <= size:
        return out
    gram, width = (ids.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER, 1
    while width < size:  # grams of 1, 2, 4, ... words, the last step overlapping
        step = min(width, size - width)
        gram = (gram[:-step] ^ (gram[:-step] >> np.uint64(31))) * _MULTIPLIER + gram[step:]
        width += step
    order = np.argsort(gram, kind="stable")
    same = gram[order[1:]] == gram[order[:-1]]
    if not same.any():
        return out
    again = np.zeros(len(gram) + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    edges = np.zeros(n + 1, np.int64)
    edges[: len(gram)] += again[:-1]
    edges[size : size + len(gram)] -= again[:-1]
    return np.cumsum(edges[:-1]) > 0


def find_runs(words: Sequence[bytes], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start, then period."""
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    inside = np.concatenate(([False], covered(ids, least, times), [False]))
    cuts = np.flatnonzero(inside[1:] != inside[:-1])
    out = []
    for a, b in zip(cuts[::2].tolist(), cuts[1::2].tolist(), strict=True):
        out += [(a + s, size, q) for s, size, q in runs_of(ids[a:b].tolist(), least, times)]
    return out


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words, but of each run only the first period and what no run repeats."""
    if not runs:
        return list(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, size, period in runs:
        gone[start + period] += 1
        gone[start + size] -= 1
    return [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]


def strongest(runs: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for start, size, period in runs:  # by start, then period: the first of equals stays
        if best is None or size * best[2] > best[1] * period:
            best = (start, size, period)
    return best


def looped(words: list[bytes], h: int) -> list[bytes]:
    """For every tenth ``h``: the words from a place on replaced by a loop over those after it."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


RESULT = (
    T.StructType()
    .add("runs", T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long")))
    .add("collapsed", "string")
)


def _apply(docs: DataFrame, id_col: str, text_col: str, schema: T.StructType, row) -> DataFrame:
    """``doc_id`` and what ``row`` makes of each document's words."""
    chosen = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("text"),
        F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("h"),
    )

    def handle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(t.split(), h) for t, h in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [
                pa.array([r[k] for r in rows], type_) for k, type_ in enumerate(arrow_types)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    arrow_types = [to_arrow_type(f.dataType) for f in schema.fields]
    whole = T.StructType([chosen.schema["doc_id"], *schema.fields])
    names = whole.names
    return chosen.mapInArrow(handle, whole)


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """doc_id, ``runs`` (start, length, period each) and ``collapsed``, the words that stay."""

    def row(words: list[bytes], h: int) -> tuple:
        runs = find_runs(words, least, times)
        return [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], _joined(words, runs)

    return _apply(docs, id_col, text_col, RESULT, row)


def _joined(words: list[bytes], runs) -> str:
    return b" ".join(collapse(words, runs)).decode("utf-8", "surrogatepass")


DIGEST = (
    T.StructType()
    .add("n_runs", "long")
    .add("start", "long")
    .add("length", "long")
    .add("period", "long")
    .add("exponent_milli", "long")
    .add("runs_sha256", "string")
    .add("collapsed_sha256", "string")
)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: number of runs, the strongest one, and hashes of the runs and kept words.

    Documents whose id's crc32 ends in 0 are looped first (``looped``).
    """

    def row(words: list[bytes], h: int) -> tuple:
        words = looped(words, h)
        runs = find_runs(words)
        best = strongest(runs)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        return (
            len(runs),
            *(best or (None, None, None)),
            1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest(),
        )

    return _apply(docs, id_col, text_col, DIGEST, row)

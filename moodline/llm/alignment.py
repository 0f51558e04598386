"""Alignment of two tokenizers' tokens, as a monoid of fragments.

Two tokenizers cut the same bytes differently. Where tokens of both end at once, the bytes are cut
into groups; tokens of one group are linked. A fragment says what a range of bytes knows by itself:
the tokens before its first common end (open prefix), the groups after it (closed), and the tokens
behind its last common end (open suffix); without a common end all its tokens are open. Two
fragments compose: the open suffix of the left and the open prefix of the right close one more
group. This is associative, with the fragment of no tokens as its unit, so fragments of a text may be
composed in any grouping.

Texts are cut into byte ranges. A task tokenizes a range from the last safe place before it to the
first one after it, and keeps the tokens that end within it. A place is safe where neither tokenizer
can join the bytes on both sides: a space between ASCII letters or digits, provided that no piece of the
second vocabulary has a space behind another character. A range's end without a safe place nearby
is left out, so ranges then get longer. Ranges of long texts are spread over tasks and composed by a
tree of ``FAN`` fragments a step; texts of one range stay in their tasks.

A pair of ids counts the texts that hold it linked. Counts are summed per task before the shuffle. The
table of pairs is broadcast where it is measured small; otherwise it is joined by shuffle, with salted
keys, since a frequent pair is in nearly every text.

A text takes part if both tokenizers' bytes are a space and the text; one that doesn't, like a null or
empty one, has no tokens: zeros and an empty string. Special tokens' strings are plain text. Rows are
texts of their own, so repeated ones count each; ids may be null; other columns are not looked at; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from moodline.llm.bpe import PATTERN, byte_letters
from moodline.llm.common import Parcel, text_of
from moodline.operators.lookup import lookup_join
from moodline.session import stage

RANGE = 1 << 16  # bytes of a range
FAN = 8  # fragments composed by one step of the tree
PAIRS = 2_000_000  # of the broadcast table, of 17 bytes each
ENCODED = 1 << 18  # bytes that a task tokenizes at once, about
LARGE = 1024  # links of a group beyond which it isn't written out token by token
COUNTED = 2_000_000  # pairs a task holds before it adds them up

#: Between these a space is where both tokenizers cut.
_SAFE = re.compile(rb"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

_NONE = np.zeros(0, np.int32)


def thin(numbers: np.ndarray) -> bytes:
    """Non-negative integers, as narrow as all of them fit; the width comes first."""
    most = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def wide(data: bytes) -> np.ndarray:
    data = bytes(data)
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def packed_pairs(pairs: np.ndarray) -> tuple[bytes, bytes]:
    """Rising pairs: the steps between their first ids, and their second ids."""
    return thin(np.diff(pairs >> 32, prepend=0)), thin(pairs & 0xFFFFFFFF)


def unpacked_pairs(steps: bytes, seconds: bytes) -> np.ndarray:
    return np.cumsum(wide(steps)) << 32 | wide(seconds)


@dataclass(frozen=True)
class Fragment:
    """What a range of bytes knows. ``closed`` says whether it has a common end at all."""

    prefix: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)  # ids of both tokenizers
    suffix: tuple[np.ndarray, np.ndarray] = (_NONE, _NONE)
    closed: bool = False
    groups: bytes = b""  # the closed groups, each with a ';' behind it
    n_groups: int = 0
    tokens: tuple[int, int] = (0, 0)  # all of the range, open ones too
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # a << 32 | b, rising, of the closed groups
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # links of each pair
    same: bool = True  # whether both tokenizers' bytes are the text's

    def __add__(self, other: Fragment) -> Fragment:
        tokens = (self.tokens[0] + other.tokens[0], self.tokens[1] + other.tokens[1])
        same = self.same and other.same
        if not other.closed:
            open_ = _joined(self.suffix if self.closed else self.prefix, other.prefix)
            if self.closed:
                return Fragment(self.prefix, open_, True, self.groups, self.n_groups, tokens, self.pairs, self.times, same)
            return Fragment(prefix=open_, tokens=tokens, same=same)
        if not self.closed:
            return Fragment(
                _joined(self.prefix, other.prefix), other.suffix, True, other.groups, other.n_groups, tokens,
                other.pairs, other.times, same,
            )
        middle = _joined(self.suffix, other.prefix)
        pairs, times = _added([(self.pairs, self.times), links([middle]), (other.pairs, other.times)])
        return Fragment(
            self.prefix, other.suffix, True, self.groups + written([middle]) + other.groups,
            self.n_groups + 1 + other.n_groups, tokens, pairs, times, same,
        )

    def whole(self) -> Fragment:
        """As a text: its start is a cut, so the open prefix is its first group. Unlike bytes: no tokens."""
        return Fragment(closed=True) + self if self.same and self.closed else Fragment()

    def packed(self) -> tuple:
        ids = [*self.prefix, *self.suffix]
        return (
            *[i.astype("<i4").tobytes() for i in ids], self.closed, self.groups, self.n_groups, *self.tokens,
            *packed_pairs(self.pairs), thin(self.times), self.same,
        )

    @classmethod
    def unpacked(cls, a, b, c, d, closed, groups, n_groups, n_a, n_b, steps, seconds, times, same) -> Fragment:
        a, b, c, d = (np.frombuffer(x, "<i4") for x in (a, b, c, d))
        return cls(
            (a, b), (c, d), bool(closed), bytes(groups), int(n_groups), (int(n_a), int(n_b)),
            unpacked_pairs(steps, seconds), wide(times), bool(same),
        )


FIELDS = (
    "prefix_a binary, prefix_b binary, suffix_a binary, suffix_b binary, closed boolean, groups binary, "
    "n_groups long, n_a long, n_b long, steps binary, seconds binary, times binary, same boolean"
)
_ARROW = (
    *[pa.binary()] * 4, pa.bool_(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.bool_(),
)
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def _joined(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate((left[0], right[0])), np.concatenate((left[1], right[1]))


def _added(parts: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Times of equal pairs added up."""
    keys = np.concatenate([k for k, _ in parts])
    times = np.concatenate([t for _, t in parts])
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights=times, minlength=len(found)).astype(np.int64)


def links(groups: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of ids in groups, rising, and how often each is linked: by distinct ids, not by tokens."""
    parts = []
    for a, b in groups:
        a, n = np.unique(a, return_counts=True)
        b, m = np.unique(b, return_counts=True)
        parts.append(((a.astype(np.int64)[:, None] << 32 | b).ravel(), np.outer(n, m).ravel()))
    return _added(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def written(groups: Sequence[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Each group as ``a1,a2|b1;``."""
    return b"".join(
        b"%s|%s;" % (b",".join(b"%d" % x for x in a.tolist()), b",".join(b"%d" % x for x in b.tolist())) for a, b in groups
    )


def fragment(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, number: np.ndarray | None = None) -> Fragment:
    """The fragment of tokens given by their ids and the byte offsets at which they end.

    ``number`` holds the ids as text, so that few have to be written anew.
    """
    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
    tokens = (len(a), len(b))
    if not len(common):
        return Fragment(prefix=(a, b), tokens=tokens)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    count_a = np.bincount(group_a, minlength=len(common) + 1)
    count_b = np.bincount(group_b, minlength=len(common) + 1)
    first, last = (count_a[0], count_b[0]), (tokens[0] - count_a[-1], tokens[1] - count_b[-1])
    prefix, suffix = (a[: first[0]], b[: first[1]]), (a[last[0] :], b[last[1] :])
    a, b = a[first[0] : last[0]], b[first[1] : last[1]]
    count_a, count_b = count_a[1:-1], count_b[1:-1]
    n = len(count_a)
    if not n:
        return Fragment(prefix, suffix, True, tokens=tokens)
    # text: tokens of a, then those of b, group by group, with what follows each
    ids = np.concatenate((a, b))
    group = np.concatenate((np.repeat(np.arange(n), count_a), np.repeat(np.arange(n), count_b)))
    side = np.repeat([0, 1], (len(a), len(b)))
    order = np.lexsort((side, group))
    mark = np.zeros(len(ids), np.int8)  # ','
    mark[np.cumsum(count_a + count_b) - 1] = 2  # ';'
    mark[np.cumsum(count_a + count_b) - count_b - 1] = 1  # '|'
    if number is None:
        number = numbers_as_text(int(ids.max()) + 1)
    text = b"".join(number[mark, ids[order]].tolist())
    # links: token by token, but those of large groups by distinct ids
    small = count_a * count_b <= LARGE
    start_a, start_b = np.cumsum(count_a) - count_a, np.cumsum(count_b) - count_b
    size = np.where(small, count_a * count_b, 0)
    at = np.repeat(np.arange(n), size)
    step = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
    left = a[start_a[at] + step // count_b[at]].astype(np.int64)
    right = b[start_b[at] + step % count_b[at]]
    found, times = np.unique(left << 32 | right, return_counts=True)
    rest = np.flatnonzero(~small).tolist()
    if rest:
        many = [(a[start_a[g] : start_a[g] + count_a[g]], b[start_b[g] : start_b[g] + count_b[g]]) for g in rest]
        found, times = _added([(found, times), links(many)])
    return Fragment(prefix, suffix, True, text, n, tokens, found, times.astype(np.int64))


def numbers_as_text(n: int) -> np.ndarray:
    """Row by row: the numbers with ',', '|' and ';' behind them."""
    return np.array([[b"%d%s" % (k, mark) for k in range(n)] for mark in (b",", b"|", b";")], object)


def _by_ranks(spec: dict, vocab: dict[str, int], of: np.ndarray) -> Callable[[list[str]], Iterator[list[int]]] | None:
    """Encoder for a file whose ids are in the order of its merges and that splits in the published way.

    Ids are then ranks, which the faster library takes. None for other files.
    """
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ranked = all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(merges)) and len(vocab) == 256 + len(merges)
    split = spec.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    if not (ranked and plain) or spec.get("normalizer") or any(spec["model"].get(o) for o in options):
        return None
    ranks = {of[i]: i for i in vocab.values()}
    encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: map(encoding.encode_ordinary, texts)


def _by_file(byte_bpe: str) -> Callable[[list[str]], Iterator[list[int]]]:
    """Encoder for any file, by the library whose format it has."""
    whole = Tokenizer.from_str(byte_bpe)
    whole.no_truncation()
    whole.no_padding()
    whole.encode_special_tokens = True
    return lambda texts: (e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False))


class Tokenizers:
    """Both tokenizers with the bytes of their tokens. Built from the files' contents, once per worker."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        letters = byte_letters()
        spec = json.loads(byte_bpe)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in added}
        self.bytes_a = np.full(max([*vocab.values(), *added.values()]) + 1, b"", object)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.bytes_a[i] = token.encode()
        self.first = _by_ranks(spec, vocab, self.bytes_a) or _by_file(byte_bpe)
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        n = self.second.get_piece_size()
        self.bytes_b = np.full(n, b"", object)
        self.safe = True
        for i in range(n):
            piece = self.second.id_to_piece(i)
            if self.second.is_byte(i):
                self.bytes_b[i] = bytes([int(piece[3:-1], 16)])
                continue
            self.bytes_b[i] = piece.replace("▁", " ").encode()
            if not self.second.is_control(i) and re.search("[^▁]▁", piece):
                self.safe = False
        self.sizes = tuple(np.array([len(t) for t in part], np.int64) for part in (self.bytes_a, self.bytes_b))
        self.number = numbers_as_text(max(len(self.bytes_a), n))

    def encode(self, texts: Sequence[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids by both of texts that start with a space; the second tokenizer adds that itself.

        Some texts at a time, since the library's encodings are many times as large as the texts.
        """
        ends = np.cumsum([len(t) for t in texts])
        for k in np.unique(ends // ENCODED).tolist():
            some = [t.decode("utf-8", "replace") for t, e in zip(texts, ends, strict=True) if e // ENCODED == k]
            seconds = self.second.encode([t[1:] for t in some], out_type=int, num_threads=1)
            for a, b in zip(self.first(some), seconds, strict=True):
                yield np.array(a, np.int32), np.array(b, np.int32)

    def faithful(self, a: np.ndarray, b: np.ndarray, text: bytes) -> bool:
        return b"".join(self.bytes_a[a].tolist()) == text and b"".join(self.bytes_b[b].tolist()) == text

    def fragments(self, ranges: Sequence[tuple[bytes, int, int]]) -> Iterator[Fragment]:
        """Of ranges, each given as (bytes from a safe place to a safe place, start, end of the range in them).

        The bytes start with a space. Tokens that end after ``start`` and up to ``end`` are the range's.
        """
        for (text, lo, hi), (a, b) in zip(ranges, self.encode([text for text, _, _ in ranges]), strict=True):
            if not self.faithful(a, b, text):
                yield Fragment(same=False)
                continue
            ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
            in_a, in_b = ((e > lo) & (e <= hi) for e in (ends_a, ends_b))
            yield fragment(a[in_a], b[in_b], ends_a[in_a], ends_b[in_b], self.number)


def ranges_of(text: bytes, size: int, safe: bool = True) -> list[tuple[bytes, int, int]]:
    """A text's byte ranges, each with the bytes around it from one safe place to another.

    ``text`` starts with the added space. Ends lie at multiples of ``size``; one without a safe place
    within ``size`` bytes on either side is left out.
    """
    n = len(text)
    ends = [0]
    before, after = [0], []  # safe places around each start and each end
    for end in range(size, n, size) if safe else ():
        near = [m.start() for m in _SAFE.finditer(text, max(end - size, 1), min(end + size, n))]
        low = max((p for p in near if p <= end), default=None)
        high = min((p for p in near if p >= end), default=None)
        if low is None or high is None:
            continue
        ends.append(end)
        before.append(low)
        after.append(high)
    ends.append(n)
    after.append(n)
    return [
        (text[p:q], lo - p, hi - p)
        for lo, hi, p, q in zip(ends[:-1], ends[1:], before, after, strict=True)
    ]


def _rows(fragments: Sequence[Fragment], lead: Sequence[pa.Array], lead_names: Sequence[str]) -> pa.RecordBatch:
    columns = list(zip(*[f.packed() for f in fragments], strict=True)) or [()] * len(_ARROW)
    arrays = [pa.array(c, t) for c, t in zip(columns, _ARROW, strict=True)]
    return pa.RecordBatch.from_arrays([*lead, *arrays], names=[*lead_names, *_NAMES])


def aligned(docs: DataFrame, byte_bpe: str, pieces: bytes, id_col: str, text_col: str, size: int = RANGE) -> DataFrame:
    """(doc_id, fragment fields) of each row: its text as one fragment."""
    context = docs.sparkSession.sparkContext
    sent = Parcel(context, (byte_bpe, pieces))
    kind = docs.schema[id_col].dataType.simpleString()
    chosen = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))
    short = F.octet_length("text") < size

    def at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(*sent.value)
        for batch in batches:
            texts = [b" " + t for t in batch.column(1).to_pylist()]
            found = both.fragments([(t, 0, len(t)) for t in texts])
            out = [f.whole() if len(t) > 1 else Fragment(same=False) for f, t in zip(found, texts, strict=True)]
            yield _rows(out, [batch.column(0)], ["doc_id"])

    done = chosen.filter(short).mapInArrow(at_once, f"doc_id {kind}, {FIELDS}")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        safe = Tokenizers(*sent.value).safe
        for batch in batches:
            for i, (number, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                parts = ranges_of(b" " + text, size, safe)
                for at in range(0, len(parts), 16):
                    some = parts[at : at + 16]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array([i] * len(some))),
                            pa.array([number] * len(some), pa.int64()),
                            pa.array(range(at, at + len(some)), pa.int64()),
                            pa.array([len(parts)] * len(some), pa.int64()),
                            pa.array([p for p, _, _ in some], pa.binary()),
                            pa.array([lo for _, lo, _ in some], pa.int64()),
                            pa.array([hi for _, _, hi in some], pa.int64()),
                        ],
                        names=["doc_id", "rid", "place", "parts", "bytes", "lo", "hi"],
                    )

    def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(*sent.value)
        for batch in batches:
            given = zip(*[batch.column(k).to_pylist() for k in (4, 5, 6)], strict=True)
            yield _rows(list(both.fragments(list(given))), batch.columns[:4], ["doc_id", "rid", "place", "parts"])

    lead = f"doc_id {kind}, rid long, place long, parts long"
    # numbers are stored with the rows, so every pass over them meets the same
    ranges = stage(
        chosen.filter(~short)
        .withColumn("rid", F.monotonically_increasing_id())
        .mapInArrow(cut, f"{lead}, bytes binary, lo long, hi long"),
        "align-ranges",
    )
    most = ranges.agg(F.max("parts")).first()[0]
    if most is None:
        return done
    tree = stage(ranges.repartition("rid", "place").mapInArrow(by_range, f"{lead}, {FIELDS}"), "align-fragments")

    def composing(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
        def composed(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("place")
            total = reduce(Fragment.__add__, (Fragment.unpacked(*row) for row in frame[_NAMES].itertuples(index=False)))
            total = total.whole() if last else total
            row = frame.iloc[0]
            return pd.DataFrame(
                [(row["doc_id"], row["rid"], row["place"] // FAN, row["parts"], *total.packed())],
                columns=["doc_id", "rid", "place", "parts", *_NAMES],
            )

        return composed

    while most:
        last = most <= FAN
        branch = F.floor(F.col("place") / FAN).alias("branch")
        tree = tree.groupBy("rid", branch).applyInPandas(composing(last), f"{lead}, {FIELDS}")
        most = 0 if last else -(-most // FAN)
    return done.unionByName(tree.select("doc_id", *_NAMES))


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, n, best): how many texts hold a pair linked, and whether none of its first id has more."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sent(parts) -> pa.RecordBatch:
            keys, n = _added(parts)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            keys = np.concatenate([unpacked_pairs(*r) for r in rows] or [np.zeros(0, np.int64)])
            held.append(_added([(keys, np.ones(len(keys), np.int64))]))
            size += len(held[-1][0])
            if size > COUNTED:
                held = [_added(held)]
                size = len(held[0][0])
                if size > COUNTED // 2:
                    yield sent(held)
                    held, size = [], 0
        if held:
            yield sent(held)

    sums = (
        texts.select("steps", "seconds").mapInArrow(counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    )
    sums = stage(sums, "align-pairs")
    first = F.shiftright("pair", 32)
    top = sums.groupBy(first.alias("a")).agg(F.max("n").alias("top"))
    return sums.join(top, first == top["a"]).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def align(
    docs: DataFrame,
    byte_bpe_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE,
    most_pairs: int = PAIRS,
    groups_as: Callable[[Column], Column] = lambda groups: groups,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``groups`` is text like ``a1,a2|b1;a3|b2,b3``; ``groups_as`` makes something of it before the
    rows are stored. The two files are read by the driver.
    """
    with open(byte_bpe_path, encoding="utf-8") as first, open(pieces_path, "rb") as second:
        found = aligned(docs, first.read(), second.read(), id_col, text_col, range_bytes)
    spark = docs.sparkSession
    text = F.expr("substring(groups, 1, length(groups) - 1)").cast("string")  # without the last ';'
    lead = ["doc_id", "n_a", "n_b", "n_groups", groups_as(text).alias("groups")]
    texts = stage(found.select(*lead, "steps", "seconds", "times"), "align-texts")
    counts = stage(pair_counts(texts), "align-counts")
    plain = ["doc_id", "n_a", "n_b", "n_groups", "groups"]
    if counts.count() <= most_pairs:  # from the files' footers
        table = counts.toArrow()
        keys, n, best = (table.column(k).combine_chunks().to_numpy(zero_copy_only=False) for k in range(3))
        order = np.argsort(keys)
        sent = spark.sparkContext.broadcast((keys[order], n[order], best[order]))

        @F.pandas_udf("n_links long, n_best long, count_sum long")
        def sums(steps: pd.Series, seconds: pd.Series, times: pd.Series) -> pd.DataFrame:
            keys, n, best = sent.value
            out = []
            for s, b, t in zip(steps, seconds, times, strict=True):
                at, t = np.searchsorted(keys, unpacked_pairs(s, b)), wide(t)
                out.append((t.sum(), t[best[at]].sum(), (t * n[at]).sum()))
            return pd.DataFrame(out, columns=["n_links", "n_best", "count_sum"])

        return texts.select(*plain, sums("steps", "seconds", "times").alias("s")).select(*plain, "s.*")

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, s, b, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                keys, times = unpacked_pairs(s, b), wide(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), rid)), pa.array(keys), pa.array(times)], names=["rid", "pair", "times"]
                )

    rows = stage(texts.withColumn("rid", F.monotonically_increasing_id()), "align-rows")
    each = rows.select("rid", "steps", "seconds", "times").mapInArrow(exploded, "rid long, pair long, times long")
    sums = (
        lookup_join(each, counts, "pair", spread="rid", max_rows=most_pairs)
        .groupBy("rid")
        .agg(
            F.sum("times").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    none = F.lit(0).cast("long")
    return rows.join(sums, "rid", "left").select(
        *plain, *[F.coalesce(F.col(c), none).alias(c) for c in ("n_links", "n_best", "count_sum")]
    )

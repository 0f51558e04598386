"""Byte-level BPE encoding and decoding with an index of pair occurrences.

Texts of a partition are split into pre-tokens, and the distinct ones are laid out as arrays of
symbols, of a bounded size each. An index maps the rank of each mergeable pair to all its positions. Ranks that occur are
taken in ascending order; all positions of a rank merge at once, and the pairs that appear or vanish
beside them update the lists of their ranks. A rank nobody uses costs nothing, and a word that occurs
a million times is merged once.

Ids are those of the vocabulary file, special tokens in a text included, and are kept as bytes, four
little-endian ones an id. Nothing is shuffled. A null text is the empty text and has no ids; a null
id stays null; repeated rows are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from moodline.llm.common import Parcel

#: The published split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters of a partition whose distinct words are encoded once, and bytes of them that share an
#: index: both bound a task's memory, not its result.
INDEXED_CHARS = 5_000_000
INDEXED_BYTES = 1 << 18

END, GONE = -1, -2  # end of a word; a symbol merged into the one before it


def byte_letters() -> dict[str, int]:
    """Letter of the vocabulary file -> byte. Printable Latin-1 stands for itself, the rest follows 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Vocabulary:
    """Merges and tokens as arrays; of a bounded size, so it travels with the tasks."""

    def __init__(self, spec: dict):
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int32)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.size = max([*ids.values(), *added.values()]) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.tokens[i] = token.encode()
        self.byte_ids = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_ids[b] = ids[letter]
        self.special = added
        keys = self.left * self.size + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            return cls(json.load(file))

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for pairs that don't merge."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -1
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)


def encode_words(words: Sequence[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words, one after the other, and how many each has."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1) - 1  # each word is followed by END
    n = int(ends[-1]) + 1
    sym = np.full(n, END, np.int32)
    inside = np.ones(n, bool)
    inside[ends] = False
    sym[inside] = vocab.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.minimum(np.arange(1, n + 1, dtype=np.int32), n - 1)
    before = np.maximum(np.arange(-1, n - 1, dtype=np.int32), 0)
    before[0] = n - 1  # an END: the first symbol has nothing before it

    # the index: rank -> arrays of positions
    places: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def note(position: np.ndarray, rank: np.ndarray) -> None:
        found = rank >= 0
        if not found.any():
            return
        position, rank = position[found], rank[found]
        by_rank = np.argsort(rank, kind="stable")
        position, rank = position[by_rank], rank[by_rank]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, group in zip(rank[np.r_[0, cuts]].tolist(), np.split(position, cuts), strict=True):
            if r in places:
                places[r].append(group)
            else:
                places[r] = [group]
                heapq.heappush(active, r)

    bytes_only = np.full((256, 256), -1, np.int32)
    grid = np.arange(256)
    bytes_only[:] = vocab.ranks(
        np.repeat(vocab.byte_ids, 256), np.tile(vocab.byte_ids, 256)
    ).reshape(256, 256)
    as_byte = np.zeros(vocab.size, np.int32)
    as_byte[vocab.byte_ids] = grid
    here = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0)).astype(np.int32)
    note(here, bytes_only[as_byte[sym[here]], as_byte[sym[here + 1]]])

    while active:
        rank = heapq.heappop(active)
        groups = places.pop(rank)
        at = groups[0] if len(groups) == 1 else np.unique(np.concatenate(groups))
        a, b, new = int(vocab.left[rank]), int(vocab.right[rank]), int(vocab.merged[rank])
        at = at[(sym[at] == a) & (sym[after[at]] == b)]
        if not len(at):
            continue
        if a == b:  # of a run of overlapping pairs, every other one from the left
            at = np.unique(at)
            joined = np.r_[False, after[at[:-1]] == at[1:]]
            place = np.arange(len(at))
            at = at[(place - np.maximum.accumulate(np.where(joined, 0, place))) % 2 == 0]
        gone = after[at]
        sym[at], sym[gone] = new, GONE
        follow = after[gone]
        after[at] = follow
        before[follow] = at
        ahead = before[at]
        note(
            np.concatenate((ahead, at)),
            vocab.ranks(np.concatenate((sym[ahead], sym[at])), np.concatenate((sym[at], sym[follow]))),
        )

    left = sym >= 0
    of_word = np.repeat(np.arange(len(words)), sizes + 1)
    return sym[left], np.bincount(of_word[left], minlength=len(words))


class Splitter:
    """Pre-tokens of texts as numbers of distinct words; special tokens have numbers of their own."""

    def __init__(self, vocab: Vocabulary):
        self.find = regex.compile(PATTERN).findall
        self.special = vocab.special
        self.cut = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(vocab.special, key=len, reverse=True))) + ")")
            if vocab.special
            else None
        )
        self.numbers: dict[str, int] = {}

    def split(self, text: str) -> np.ndarray:
        number, numbers = self.numbers.setdefault, self.numbers
        if self.cut is not None and any(s in text for s in self.special):
            out = []
            for k, piece in enumerate(self.cut.split(text)):
                out += [-1 - self.special[piece]] if k % 2 else [
                    number(w, len(numbers)) for w in self.find(piece)
                ]
        else:
            out = [number(w, len(numbers)) for w in self.find(text)]
        return np.array(out, np.int32)


def slices(words: Iterable[str], most: int) -> Iterator[list[bytes]]:
    """The words in order, as many at a time as have ``most`` bytes; a longer one comes with those before it."""
    held, size = [], 0
    for word in words:
        held.append(word.encode("utf-8"))
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def encode_texts(
    texts: Sequence[np.ndarray], numbers: Iterable[str], vocab: Vocabulary, most: int = INDEXED_BYTES
) -> Iterator[np.ndarray]:
    """Ids of each text, given as its word numbers; ``most`` bytes of words share an index."""
    parts = [encode_words(words, vocab) for words in slices(numbers, most)] or [encode_words([], vocab)]
    flat, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    del parts
    n_words = len(sizes)
    # special tokens follow the words: -1 - id becomes a place behind them
    flat = np.concatenate((flat, np.arange(vocab.size, dtype=np.int32)))
    starts = np.concatenate((np.cumsum(sizes) - sizes, len(flat) - vocab.size + np.arange(vocab.size)))
    sizes = np.concatenate((sizes, np.ones(vocab.size, np.int64)))
    for words in texts:
        place = np.where(words >= 0, words, n_words - 1 - words)
        size = sizes[place]
        offset = np.cumsum(size) - size
        yield flat[np.repeat(starts[place] - offset, size) + np.arange(int(size.sum()))]


def decode(ids: np.ndarray, tokens: np.ndarray) -> str:
    """The text of ids; byte sequences that aren't UTF-8 become replacement characters."""
    return b"".join(tokens[ids].tolist()).decode("utf-8", "replace")


def tokenize(
    docs: DataFrame,
    path: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    indexed_chars: int = INDEXED_CHARS,
) -> DataFrame:
    """The kept columns with ``ids`` (bytes), ``n_tokens`` and ``decoded``, the ids' text.

    ``path`` is read by the driver. Kept columns of the same names give way.
    """
    own = T.StructType().add("ids", "binary").add("n_tokens", "long").add("decoded", "string")
    kept = [c for c in keep if c not in own.names]
    chosen = docs.select(docs[f"`{text_col}`"].cast("string").alias("ids"), *[docs[f"`{c}`"] for c in kept])
    schema = T.StructType([*chosen.schema.fields[1:], *own.fields])
    shared = Parcel(docs.sparkSession.sparkContext, Vocabulary.read(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        tokens = np.array(vocab.tokens, object)

        def indexed(held: list[tuple[pa.RecordBatch, list[np.ndarray]]], numbers: dict[str, int]):
            ids = encode_texts([t for _, texts in held for t in texts], numbers, vocab)
            for rest, texts in held:
                mine = [next(ids) for _ in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *rest.columns,
                        pa.array([i.astype("<u4").tobytes() for i in mine], pa.binary()),
                        pa.array([len(i) for i in mine], pa.int64()),
                        pa.array([decode(i, tokens) for i in mine], pa.string()),
                    ],
                    names=schema.names,
                )

        held, chars, splitter = [], 0, Splitter(vocab)
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            rest = batch.select(list(range(1, batch.num_columns)))
            held.append((rest, [splitter.split(t) for t in texts]))
            chars += sum(map(len, texts))
            if chars >= indexed_chars:
                yield from indexed(held, splitter.numbers)
                held, chars, splitter = [], 0, Splitter(vocab)
        if held:
            yield from indexed(held, splitter.numbers)

    return chosen.mapInArrow(encode, schema)

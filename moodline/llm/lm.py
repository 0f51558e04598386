"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Every token of the training documents has a place in a tree of classes, the frequent ones near its
root: 16 classes of 32 tokens, 8 of 32 x 32, 4 of 32 x 32 x 32, and so on, as deep as the counted
vocabulary needs. The next token's probability is the product of softmaxes down its path, over sums of
weights looked up by hashed features: none, the token before, the one before that (skip), and both
together. The last leaf stands for all tokens that training has not seen. Weights start at the counts'
logarithms, so that the untrained model gives the base score, and the hashed table grows with the
vocabulary. They are trained by gradient updates on all tasks side by side, each on every position of
its own documents. Tasks pass on the rows that they touched, in blocks; a row's updates are averaged by
the positions that touched it, in groups of bounded size.

Counts cover all training documents. Tokens frequent enough for a bounded table are looked up in
place; the others are numbered by count and joined by shuffle, one row for each parcel of documents and
distinct token. After that texts are arrays of numbers.

A null or empty text is one end token. Null ids count as empty text for the fold. Repeated rows are
scored, and trained on, each. Without training documents nothing is known. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodline.llm.common import Parcel
from moodline.session import stage

END = b""  # no word is empty
TABLE = 1 << 18  # most frequent tokens that are looked up in place, at most
CLASSES, WIDTH = 32, 32  # branches of a root, the last one the escape, and of all other nodes
SHARES = (16, 8, 4, 2, 1)  # a root's branches to classes of each depth, all but the escape
ROWS = (1 << 14, 1 << 15)  # their sum is the size of the weight table of a small vocabulary
KINDS_PER_ROW = 8  # of a large one
BATCH, STEP = 512, 0.2  # positions of an update; AdaGrad's step
PLANNED = 16  # updates whose rows are looked up and sorted at once
SCORED = 1 << 12  # positions whose rows are looked up at once
OFTEN = 64  # lines of a row in an update from which on they are summed on their own
CHUNK = 1 << 12  # softmaxes computed at once in scoring
PARCEL = 1 << 14  # bytes of texts that make a row of numbers, or one longer text
PARCELS = 128  # of them are held as whole numbers at once
FLUSH = 400_000  # distinct tokens a task counts before it passes them on
BLOCK = 1 << 11  # rows of a block
PER_ROW = 64  # positions that a training task has for each row of the table, if there are tasks enough
GATHER = 64  # updates summed by one task

OUTSIDE = CLASSES - 1
START = np.uint64(1 << 40)


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Tokens but ends, A-Z in lower case, in a row, and which text each is of. White space is that of ``words``."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    of = np.repeat(np.arange(len(texts)), pc.list_value_length(found).to_numpy(zero_copy_only=False))
    flat = found.flatten()
    some = pc.greater(pc.binary_length(flat), 0)  # white space at an end leaves an empty one
    return flat.filter(some).cast(pa.binary()), of[some.to_numpy(zero_copy_only=False)]


def counts_of(docs: DataFrame, text: Column) -> DataFrame:
    """token, c: occurrences of each token, ends included."""

    def merged(parts: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(parts).group_by("token", use_threads=False).aggregate([("c", "sum")])
        return table.select(["token", "c_sum"]).rename_columns(["token", "c"]).combine_chunks()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        held, ends = 0, 0
        for batch in batches:
            ends += batch.num_rows
            each = pc.value_counts(split_texts(batch.column(0))[0])
            parts.append(pa.RecordBatch.from_arrays(each.flatten(), names=["token", "c"]))
            held += len(each)
            if held > 2 * FLUSH:
                parts = merged(parts).to_batches()
                held = sum(p.num_rows for p in parts)
                if held > FLUSH:
                    yield from parts
                    parts, held = [], 0
        if held:
            yield from merged(parts).to_batches()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["token", "c"])

    return docs.select(text.alias("text")).mapInArrow(count, "token binary, c long").groupBy("token").agg(
        F.sum("c").alias("c")
    )


@dataclass
class Lexicon:
    """The frequent tokens, by falling count, which numbers them."""

    tokens: pa.Array
    counts: np.ndarray

    @classmethod
    def of(cls, tokens: Sequence[bytes], counts: np.ndarray) -> Lexicon:
        order = sorted(range(len(tokens)), key=lambda i: (-counts[i], tokens[i]))
        return cls(pa.array([bytes(tokens[i]) for i in order], pa.binary()), np.asarray(counts, np.int64)[order])

    def read(self, texts: pa.Array, parcel: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """Numbers of the texts' tokens in a row, the rare ones as -1 - place, how many each text has, how many
        distinct rare ones each ``parcel`` of texts, and those, parcel by parcel."""
        flat, of = split_texts(texts)
        coded = flat.dictionary_encode()
        kinds = pa.concat_arrays([coded.dictionary, pa.array([END], pa.binary())])
        length = np.bincount(of, minlength=len(texts)) + 1
        kind = np.full(length.sum(), len(kinds) - 1, np.int64)
        kind[np.arange(len(of)) + of] = coded.indices.to_numpy(zero_copy_only=False)
        known = pc.fill_null(pc.index_in(kinds, value_set=self.tokens), -1).to_numpy(zero_copy_only=False)
        numbers = known.astype(np.int64).take(kind)
        rare = np.flatnonzero(numbers < 0)
        of = np.repeat(parcel, length).take(rare)
        key = of * len(kinds) + kind.take(rare)
        order = sorted_places(key, len(key).bit_length())
        key = key.take(order)
        first = starts_of(key)
        place = np.repeat(np.arange(len(first)), np.diff(first, append=len(key)))
        key = key.take(first)
        n_rare = np.bincount(key // len(kinds), minlength=parcel[-1] + 1)
        rare = rare.take(order)
        numbers[rare] = -1 - place + np.repeat(np.cumsum(n_rare) - n_rare, np.bincount(of, minlength=len(n_rare)))
        return numbers, length, n_rare, kinds.take(pa.array(key % len(kinds)))


def packed(numbers: np.ndarray) -> np.ndarray:
    """Two bytes for numbers near 0, four for others below 2^29; the first two of four have the top bit set."""
    code = np.where(numbers < 0, -2 * numbers - 1, 2 * numbers)
    large = code >= 1 << 15
    at = np.arange(len(code)) + np.cumsum(large)
    out = np.empty(len(code) + np.count_nonzero(large), np.uint16)
    out[at] = code & 0x7FFF
    out[at[large] - 1] = 0x8000 | code[large] >> 15
    return out


def unpacked(halves: np.ndarray) -> np.ndarray:
    first = halves >= 1 << 15
    last = np.flatnonzero(~first)
    code = halves.take(last).astype(np.int64)
    large = np.flatnonzero(first)
    code[large - np.arange(len(large))] |= (halves.take(large).astype(np.int64) & 0x7FFF) << 15
    return np.where(code & 1, -(code + 1) // 2, code >> 1)


def _mixed(h: np.ndarray, rows: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(33)) % np.uint64(rows)).astype(np.int64)


def contexts(numbers: np.ndarray, starts: Sequence[int] = (0,)) -> np.ndarray:
    """Hashes of the three features at each position of texts that begin at ``starts``."""
    own = (numbers + (1 << 20)).astype(np.uint64)
    starts = np.asarray(starts, np.int64)
    one, two = np.roll(own, 1), np.roll(own, 2)
    one[starts] = two[starts] = START
    second = starts + 1
    two[second[second < len(own)]] = START
    return np.stack(
        (
            one * np.uint64(4) + np.uint64(1),
            two * np.uint64(4) + np.uint64(2),
            (one * np.uint64(0x9E3779B1) + two) * np.uint64(4) + np.uint64(3),
        )
    )


def exponents(z: np.ndarray, out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(z - top), its sum by row, and top: 0 unless a row's sum leaves the range of the type."""
    with np.errstate(over="ignore"):
        e = np.exp(z, out=out)
    total = e.dot(np.ones(e.shape[1], e.dtype))
    if not len(z) or (total.min() > 1e-20 and total.max() < 1e20):
        return e, total, 0.0
    top = z.max(axis=1)
    np.exp(z - top[:, None], out=e)
    return e, e.sum(axis=1), top


def sorted_places(keys: np.ndarray, bits: int) -> np.ndarray:
    """Places of the keys in ascending order; ``bits`` hold any place."""
    packed = keys << bits
    packed |= np.arange(len(keys))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed


def starts_of(keys: np.ndarray) -> np.ndarray:
    """Where each distinct one of the sorted keys begins."""
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    return np.flatnonzero(new)


def summed(z: np.ndarray, lines: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the lines that lie side by side in ``lines``; most are of one or two."""
    out = z.take(lines.take(first), axis=0)
    twice = np.flatnonzero(times > 1)
    out[twice] += z.take(lines.take(first.take(twice) + 1), axis=0)
    for k in np.flatnonzero(times >= OFTEN):
        out[k] = z.take(lines[first[k] : first[k] + times[k]], axis=0).sum(axis=0)
    some = np.flatnonzero((times > 2) & (times < OFTEN))
    if len(some):
        length = times.take(some) - 2
        start = np.cumsum(length) - length
        rest = np.repeat(first.take(some) + 2 - start, length) + np.arange(int(length.sum()))
        out[some] += np.add.reduceat(z.take(lines.take(rest), axis=0), start, axis=0)
    return out


def _square(gradient: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", gradient, gradient) / np.float32(WIDTH)


def put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """table[at] = rows, a whole row at a time."""
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    np.put(table.view(whole)[:, 0], at, rows.view(whole)[:, 0], mode="clip")


class Tree:
    """Paths of the numbers below ``leaves``. A root's branches lead to 16 classes of 32 numbers, 8 of 32^2, 4 of 32^3
    and so on; its last branch is the escape to a further root, whose classes are deeper."""

    def __init__(self, leaves: int):
        self.leaves = leaves
        self.shells: list[tuple[int, int, int, list[int]]] = []  # first number, numbers, first branch, first node of each level
        self.escapes: list[tuple[int, int]] = []  # root, first number outside
        self.partial: list[tuple[int, int]] = []  # nodes with fewer branches, and how many
        self.nodes, start, depth = 0, 0, 0
        while start < leaves:
            root, used = self.nodes, 0
            self.nodes += 1
            for classes in SHARES:
                depth += 1
                size = min(leaves - start, classes * WIDTH**depth)
                if not size:
                    continue
                levels = [root]
                for level in range(1, depth + 1):
                    branches = -(-size // WIDTH ** (depth - level))
                    levels.append(self.nodes)
                    self.nodes += -(-branches // WIDTH)
                    if branches % WIDTH:
                        self.partial.append((self.nodes - 1, branches % WIDTH))
                self.shells.append((start, size, used, levels))
                used += -(-size // WIDTH**depth)
                start += size
            if start < leaves:
                self.escapes.append((root, start))
            else:
                self.partial.append((root, used))
        self.branches = np.full(self.nodes, WIDTH)
        for partial, branches in self.partial:
            self.branches[partial] = branches

    def paths(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in ``numbers``, node and branch of every step down."""
        at, node, branch = [], [], []
        for root, outside in self.escapes:
            place = np.flatnonzero(numbers >= outside)
            at.append(place)
            node.append(np.full(len(place), root))
            branch.append(np.full(len(place), OUTSIDE))
        for start, size, used, levels in self.shells:
            place = np.flatnonzero((numbers >= start) & (numbers < start + size))
            if not len(place):
                continue
            up = numbers.take(place) - start
            for first in levels[:0:-1]:
                at.append(place)
                up, own = np.divmod(up, WIDTH)
                node.append(first + up)
                branch.append(own)
            at.append(place)
            node.append(np.full(len(place), levels[0]))
            branch.append(used + up)
        return np.concatenate(at), np.concatenate(node), np.concatenate(branch)

    def initial(self, ends: np.ndarray, mass: np.ndarray) -> np.ndarray:
        """Weights of the constants: ``mass`` of all numbers below each of ``ends``, linear between."""
        part = np.zeros((self.nodes, WIDTH))
        for start, size, used, levels in self.shells:
            depth = len(levels) - 1
            for level, first in enumerate(levels):
                step = WIDTH ** (depth - level)
                edges = start + np.minimum(np.arange(-(-size // step) + 1) * step, size)
                below = np.diff(np.interp(edges, ends, mass))
                part[first:].reshape(-1)[used * (level == 0) :][: len(below)] = below
        for root, outside in self.escapes:
            part[root, OUTSIDE] = mass[-1] - np.interp(outside, ends, mass)
        return np.log(np.maximum(part, 1e-9) / part.sum(axis=1, keepdims=True)).astype(np.float32)


class Model:
    def __init__(self, weights: np.ndarray, tree: Tree | None = None):
        table = weights.reshape(-1, WIDTH)
        self.tree = tree or Tree(OUTSIDE * WIDTH + 1)
        self.constants, self.hashed = table[: self.tree.nodes], table[self.tree.nodes :]

    @classmethod
    def of(cls, tree: Tree, constants: np.ndarray, hashed: np.ndarray) -> Model:
        model = cls(constants, tree)
        model.hashed = hashed
        return model

    @classmethod
    def rows_for(cls, tree: Tree) -> int:
        """Hashed rows."""
        return max(sum(ROWS), tree.leaves // KINDS_PER_ROW)

    def rows(self, features: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Hashed rows of the features at nodes."""
        return _mixed(features + node.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), len(self.hashed))

    def sums(self, features: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits at nodes, and the hashed rows they came from."""
        rows = self.rows(features, node)
        z = self.constants.take(node, axis=0)
        for r in rows:
            z += self.hashed.take(r, axis=0)
        self.cut(z, node, np.flatnonzero(self.tree.branches.take(node) < WIDTH))
        return z, rows

    def cut(self, z: np.ndarray, node: np.ndarray, lines: np.ndarray) -> None:
        """Leaves no weight to the branches that the nodes of ``lines`` don't have."""
        if len(lines):
            z[lines] = np.where(np.arange(WIDTH) < self.tree.branches[node[lines]][:, None], z[lines], -np.inf)

    def logs(self, numbers: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability at each position."""
        out = np.zeros(len(numbers))
        z, e = np.empty((2, CHUNK, WIDTH), np.float32)
        x = np.empty((CHUNK, WIDTH), self.hashed.dtype)
        for first in range(0, len(numbers), SCORED):
            last = first + SCORED
            at, node, branch = self.tree.paths(numbers[first:last])
            rows = self.rows(features[:, first:last].take(at, axis=1), node)
            short = self.tree.branches.take(node) < WIDTH
            own, total = np.empty((2, len(at)), np.float32)
            top = np.zeros(len(at), np.float32)
            for k in range(0, len(at), CHUNK):
                part = slice(k, k + CHUNK)
                n = len(node[part])
                self.constants.take(node[part], axis=0, out=z[:n], mode="clip")
                for r in rows:
                    z[:n] += self.hashed.take(r[part], axis=0, out=x[:n], mode="clip")
                self.cut(z, node[part], np.flatnonzero(short[part]))
                own[part] = z.ravel().take(np.arange(0, n * WIDTH, WIDTH) + branch[part])
                _, total[part], top[part] = exponents(z[:n], e[:n])
            out[first:last] = np.bincount(at, own.astype(np.float64) - top - np.log(total), len(out[first:last]))
        return out

    def log10(self, numbers: np.ndarray) -> float:
        """Of a text."""
        return float(self.logs(numbers, contexts(numbers)).sum()) / np.log(10)


@dataclass
class Update:
    """Where the weights of one update are. Its softmaxes are lines by node; a line has a row for each feature."""

    node: np.ndarray  # of each line
    own: np.ndarray  # place of its branch among all lines' branches
    short: np.ndarray  # lines whose node has fewer branches
    rows: np.ndarray  # of the table, which begins with the constants
    once: np.ndarray  # whether a row is met once, 1 or 0
    often: np.ndarray  # distinct others, nodes first
    lines: np.ndarray  # where they are met, side by side
    first: np.ndarray  # and where each one's lines begin


def planned(model: Model, numbers: np.ndarray, features: np.ndarray, batch: int) -> Iterator[Update]:
    """Updates of ``batch`` positions each. Sorting for several at once costs less than for each."""
    at, node, branch = model.tree.paths(numbers)
    step = at // batch
    order = sorted_places(step * model.tree.nodes + node, len(at).bit_length())
    at, node, branch, step = at.take(order), node.take(order), branch.take(order), step.take(order)
    rows = model.rows(features.take(at, axis=1), node)
    short = np.flatnonzero(model.tree.branches.take(node) < WIDTH)
    groups = starts_of(step * model.tree.nodes + node)
    # rows that an update meets more than once
    size, bits = len(model.hashed), rows.size.bit_length()
    keys = (rows + step * size).ravel() << bits
    keys |= np.arange(len(keys))
    keys.sort()
    same = (keys[1:] >> bits) == (keys[:-1] >> bits)
    more = np.zeros(len(keys), bool)
    more[1:] = same
    more[:-1] |= same
    keys = keys[more]
    place = keys & ((1 << bits) - 1)
    keys >>= bits
    once = np.ones(rows.size, np.float32)
    once[place] = 0
    once = once.reshape(rows.shape)
    place %= len(at)
    first = starts_of(keys)
    often = keys.take(first)
    rows += model.tree.nodes
    # all of it by update
    ends = np.searchsorted(step, np.arange(-(-len(numbers) // batch) + 1))
    cuts = [np.searchsorted(x, ends) for x in (short, groups)]
    cuts.append(np.searchsorted(often, np.arange(len(ends)) * size))
    first = np.append(first, len(keys))
    for k in range(len(ends) - 1):
        start, end = ends[k], ends[k + 1]
        (a, b), (c, d), (e, f) = (x[k : k + 2] for x in cuts)
        lines, at = np.arange(end - start), first[e]
        yield Update(
            node=node[start:end],
            own=branch[start:end] + lines * WIDTH,
            short=short[a:b] - start,
            rows=rows[:, start:end],
            once=once[:, start:end],
            often=np.concatenate((node.take(groups[c:d]), often[e:f] + (model.tree.nodes - k * size))),
            lines=np.concatenate((lines, place[at : first[f]] - start)),
            first=np.concatenate((groups[c:d] - start, first[e:f] + (len(lines) - at))),
        )


class Trainer:
    """AdaGrad on weights of its own; a row's step follows the mean square of its gradients."""

    def __init__(self, tree: Tree, constants: np.ndarray, rows: int):
        nodes = len(constants)
        self.start = constants
        self.table = np.zeros((nodes + rows, WIDTH), np.float32)
        self.table[:nodes] = constants
        self.model = Model.of(tree, self.table[:nodes], self.table[nodes:])
        self.square, self.touch = np.ones(nodes + rows, np.float32), np.zeros(nodes + rows, np.uint32)
        self.squares, self.touched = ((x[:nodes], x[nodes:]) for x in (self.square, self.touch))
        self.room = np.empty((3, 0, WIDTH), np.float32)

    def learn(self, numbers: np.ndarray, features: np.ndarray) -> None:
        """Updates over all positions, in their order."""
        for first in range(0, len(numbers), PLANNED * BATCH):
            last = first + PLANNED * BATCH
            for x in planned(self.model, numbers[first:last], features[:, first:last], BATCH):
                self._change(x)

    def update(self, numbers: np.ndarray, features: np.ndarray) -> None:
        for x in planned(self.model, numbers, features, len(numbers)):
            self._change(x)

    def _change(self, x: Update) -> None:
        width, lines = x.rows.shape
        if self.room.shape[1] < lines:
            self.room = np.empty((width + 2, lines, WIDTH), np.float32)
        z, other, held = self.room[0, :lines], self.room[1, :lines], self.room[2:, :lines]
        self.table.take(x.node, axis=0, out=z, mode="clip")
        for k in range(width):
            z += self.table.take(x.rows[k], axis=0, out=held[k], mode="clip")
        self.model.cut(z, x.node, x.short)
        e, total, _ = exponents(z, other)
        np.multiply(e, (1 / total)[:, None], out=z)
        z.ravel()[x.own] -= 1  # the gradient
        # what was read of rows that are met once is changed and put back; all others are as they were, then summed
        was = self.square.take(x.often)
        squares = self.square.take(x.rows)
        squares += _square(z)
        self.square[x.rows] = squares
        by = x.once * (STEP / np.sqrt(squares))
        for k in range(width):
            held[k] -= np.multiply(z, by[k][:, None], out=other)
            put(self.table, x.rows[k], held[k])
        times = np.diff(x.first, append=len(x.lines))
        counted = self.touch.take(x.often) + times  # below 2^32 positions a task
        self.touch[x.rows] += 1
        self.touch[x.often] = counted
        gradient = summed(z, x.lines, x.first, times)
        was += _square(gradient)
        self.square[x.often] = was
        gradient *= (STEP / np.sqrt(was))[:, None]
        put(self.table, x.often, np.subtract(self.table.take(x.often, axis=0), gradient, out=gradient))

    def moved(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Block, its touched rows, the positions that touched each, and what that changed."""
        touched = np.concatenate(self.touched)
        nodes = len(self.start)
        for first in range(0, len(touched), BLOCK):
            rows = first + np.flatnonzero(touched[first : first + BLOCK])
            if len(rows):
                low, high = rows[rows < nodes], rows[rows >= nodes] - nodes
                data = np.concatenate((self.model.constants[low] - self.start[low], self.model.hashed[high]))
                yield first // BLOCK, rows - first, touched[rows], data


# a parcel of texts a row
NUMBERED = "rid long, learn array<boolean>, n_tokens array<int>, n_rare int, numbers binary, k array<int>, number array<int>"


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all lists in a row, and how many each has; null has none."""
    column = batch.column(name)
    length = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), length.astype(np.int64)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few parcels at once."""
    for batch in batches:
        for first in range(0, batch.num_rows, PARCELS):
            yield batch.slice(first, PARCELS)


def _resolved(batch: pa.RecordBatch, unseen: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a batch's texts in a row, and how many each has."""
    length, texts = _flat(batch, "n_tokens")
    n_rare = batch.column("n_rare").to_numpy(zero_copy_only=False).astype(np.int64)
    numbers = unpacked(np.frombuffer(b"".join(batch.column("numbers").to_pylist()), np.uint16))
    if n_rare.any():
        base = np.cumsum(n_rare) - n_rare
        slots = np.full(n_rare.sum(), unseen, np.int64)
        k, found = _flat(batch, "k")
        slots[np.repeat(base, found) + k] = _flat(batch, "number")[0]
        rare = np.flatnonzero(numbers < 0)
        of = np.repeat(np.repeat(base, texts), length)
        numbers[rare] = slots[of[rare] - 1 - numbers[rare]]
    return numbers, length.astype(np.int64)


UPDATES = "block int, part long, rows binary, seen binary, data binary"


def updates(texts: DataFrame, constants, tree: Tree, rows: int) -> DataFrame:
    """What each task's gradient updates over all positions of ``texts`` (NUMBERED) change, in blocks."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, seen = None, False
        for batch in _parts(batches):
            trainer = trainer or Trainer(tree, constants.value, rows)
            numbers, length = _resolved(batch, tree.leaves - 1)
            learned = _flat(batch, "learn")[0].astype(bool)
            numbers, length = numbers[np.repeat(learned, length)], length[learned]
            trainer.learn(numbers, contexts(numbers, np.cumsum(length) - length))
        if trainer is not None:
            part = TaskContext.get().partitionId()
            for block, touched, times, data in trainer.moved():
                columns = [touched.astype(np.uint16), times.astype(np.float64), data.astype(np.float16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int32()), pa.array([part], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in columns]],
                    names=["block", "part", "rows", "seen", "data"],
                )

    return stage(texts.mapInArrow(learn, UPDATES), "lm-updates")


def averaged(frame: pd.DataFrame) -> pd.DataFrame:
    """Updates of one block as one: each row's by the positions that touched it."""
    total, seen = np.zeros((BLOCK, WIDTH)), np.zeros(BLOCK)
    for _, x in frame.sort_values("part").iterrows():
        rows, times = np.frombuffer(x["rows"], np.uint16), np.frombuffer(x["seen"], np.float64)
        total[rows] += times[:, None] * np.frombuffer(x["data"], np.float16).reshape(-1, WIDTH)
        seen[rows] += times
    at = np.flatnonzero(seen)
    row = {"block": frame["block"].iloc[0], "part": frame["part"].min() // GATHER, "rows": at.astype(np.uint16).tobytes()}
    data = (total[at] / seen[at][:, None]).astype(np.float16)
    return pd.DataFrame([row | {"seen": seen[at].tobytes(), "data": data.tobytes()}])


def train(texts: DataFrame, constants: np.ndarray, tree: Tree, positions: int) -> Model:
    """One pass of gradient updates over all positions of ``texts``, averaged over the tasks."""
    context = texts.sparkSession.sparkContext
    rows = Model.rows_for(tree)
    tasks = max(context.defaultParallelism, -(-positions // (PER_ROW * rows)))
    moved = updates(texts.coalesce(tasks), context.broadcast(constants), tree, rows)
    while moved.agg(F.max("part")).first()[0]:
        grouped = moved.groupBy("block", F.floor(F.col("part") / GATHER).alias("of"))
        moved = stage(grouped.applyInPandas(averaged, UPDATES), "lm-means")
    own, hashed = constants.copy(), np.zeros((rows, WIDTH), np.float16)
    for x in moved.toLocalIterator():  # as many rows as the model has
        at = x["block"] * BLOCK + np.frombuffer(x["rows"], np.uint16).astype(np.int64)
        data = np.frombuffer(x["data"], np.float16).reshape(-1, WIDTH)
        low = at < tree.nodes
        own[at[low]] += data[low]
        hashed[at[~low] - tree.nodes] = data[~low]
    return Model.of(tree, own, hashed)


def _frequent(sizes: Sequence[tuple[int, int]]) -> int:
    """The count from which on a token is looked up in place; ``sizes``: falling counts, tokens of each."""
    held, least = 0, 1 << 62
    for c, n in sizes:
        held += n
        if held > TABLE:
            break
        least = c
    return least


def ranked(counts: DataFrame) -> DataFrame:
    """counts, and each token's rank among those of its count in its part of the table."""

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            c = batch.column("c").to_numpy(zero_copy_only=False)
            order = sorted_places(c, len(c).bit_length())
            first = starts_of(c.take(order))
            size = np.diff(first, append=len(c))
            before = []
            for value, n in zip(c.take(order.take(first)).tolist(), size.tolist(), strict=True):
                before.append(seen.get(value, 0))
                seen[value] = before[-1] + n
            ranks = np.empty(len(c), np.int64)
            ranks[order] = np.arange(len(c)) + np.repeat(np.array(before, np.int64) - first, size)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(c), part, np.int32)), pa.array(ranks)], names=["token", "c", "part", "rank"]
            )

    return counts.sortWithinPartitions("token").mapInArrow(rank, "token binary, c long, part int, rank long")


def _others(counts: DataFrame, least: int, first: int) -> DataFrame:
    """rare, number: the tokens below ``least`` of ``ranked`` counts by falling count, numbered from ``first`` on."""
    rows = counts.filter(F.col("c") < least)
    sizes = rows.groupBy("c", "part").count().orderBy(F.desc("c"), "part").collect()  # counts below ``least`` for each task
    offsets, at = [], first
    for x in sizes:
        offsets.append((x["c"], x["part"], at))
        at += x["count"]
    table = counts.sparkSession.createDataFrame(offsets or [(0, 0, first)], "c long, part int, at long")
    numbered = rows.join(F.broadcast(table), ["c", "part"])
    return numbered.select(F.col("token").alias("rare"), (F.col("at") + F.col("rank")).cast("int").alias("number"))


def numbered_texts(docs: DataFrame, learn: Column, id_col: str, text: Column, lexicon, others: DataFrame | None) -> DataFrame:
    """NUMBERED and id: texts as numbers, in parcels. Rare ones are -1 - k; those not in k are unseen."""
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            size = pc.fill_null(pc.binary_length(batch.column(3)), 0).to_numpy(zero_copy_only=False)
            parcel = np.cumsum(size, dtype=np.int64) // PARCEL
            first = starts_of(parcel)
            at = np.append(first, len(size))
            numbers, length, n_rare, rare = lexicon.value.read(batch.column(3), np.repeat(np.arange(len(first)), np.diff(at)))
            halves = packed(numbers)
            last = np.flatnonzero(halves < 1 << 15).take(np.cumsum(length)[at[1:] - 1] - 1) + 1  # a parcel's last half
            data = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(np.append(0, 2 * last).astype(np.int32)), pa.py_buffer(halves)]
            )
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x)
                for ends, x in (
                    (at, batch.column(1)),
                    (at, batch.column(2)),
                    (at, pa.array(length, pa.int32())),
                    (np.append(0, np.cumsum(n_rare)), rare),
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(first)), *lists[:3], pa.array(n_rare, pa.int32()), data, lists[3]],
                names=["rid", "id", "learn", "n_tokens", "n_rare", "numbers", "rare"],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        text.alias("text"),
    ).mapInArrow(
        read, f"rid long, id array<{kind}>, learn array<boolean>, n_tokens array<int>, n_rare int, numbers binary, rare array<binary>"
    )
    rows = stage(rows, "lm-texts")
    if others is None:
        none = F.lit(None).cast("array<int>")
        return rows.drop("rare").withColumns({"k": none, "number": none})
    each = rows.select("rid", F.posexplode("rare").alias("k", "rare"))
    known = each.join(others, "rare").groupBy("rid").agg(F.collect_list(F.struct("k", "number")).alias("x"))
    known = known.select("rid", F.col("x.k").alias("k"), F.col("x.number").alias("number"))
    return stage(rows.drop("rare").join(known, "rid", "left"), "lm-numbers")


def score(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; trained on rows where ``learn`` holds."""
    context = docs.sparkSession.sparkContext
    text = F.col(f"`{text_col}`").cast("string")
    counts = stage(ranked(counts_of(docs.filter(learn), text)), "lm-counts")
    # numbers of tokens by count: large counts are few
    sizes = sorted(((x["c"], x["count"]) for x in counts.groupBy("c").count().collect()), reverse=True)
    c, n = (np.array([x[k] for x in sizes], np.int64) for k in (0, 1))
    total, kinds = int((c * n).sum()), int(n.sum())
    least = _frequent(sizes)
    table = counts.filter(F.col("c") >= least).select("token", "c").toPandas()  # at most TABLE rows
    lexicon = Lexicon.of([bytes(t) for t in table["token"]], table["c"].to_numpy(np.int64))
    others = _others(counts, least, len(table)) if len(table) < kinds else None
    texts = numbered_texts(docs, learn, id_col, text, Parcel(context, lexicon), others)
    tree = Tree(kinds + 1)
    ends = np.concatenate(([0], np.cumsum(n), [kinds + 1]))
    mass = np.concatenate(([0.0], np.cumsum((c + 1.0) * n), [total + kinds + 1.0]))
    constants = tree.initial(ends, mass)
    if total:
        model = train(texts.drop("id"), constants, tree, total)
    else:
        model = Model.of(tree, constants, np.zeros((1, WIDTH), np.float16))
    trained = context.broadcast((model.constants, model.hashed))
    base_of = float(np.log10(total + kinds + 1))
    steps, logs = ends[1:-1], np.append(np.log10(c + 1.0), 0.0)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, hashed = trained.value
        lm = Model.of(tree, own, hashed.astype(np.float32))  # once: half floats are slow to add
        for batch in _parts(batches):
            numbers, length = _resolved(batch, kinds)
            starts = np.cumsum(length) - length
            sums = [
                np.add.reduceat((numbers < kinds).astype(np.int64), starts),
                np.add.reduceat(logs[np.searchsorted(steps, numbers, side="right")], starts) - length * base_of,
                np.add.reduceat(lm.logs(numbers, contexts(numbers, starts)), starts) / np.log(10),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").flatten(), pa.array(length), pa.array(sums[0]), pa.array(np.full(len(length), total)), *map(pa.array, sums[1:])],
                names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return texts.mapInArrow(
        scored, f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )

"""Exact n-gram Jaccard join with token-combination prefixes.

A document is the set of its distinct 5-word shingles. Two documents link when
100 * intersection >= 80 * union. Steps:

1. Documents with equal sets are one class. A class stands for its copies from here on.
2. Of each set only a prefix is exchanged: the n - ceil(0.8 n) + k smallest hashes, k = n // 10. Sets
   that link share k of these at least, so a class with fewer shared ones is out. Then the same
   with the whole sets of what is left: 0.8 n of them must occur in other classes.
3. The shared shingles are ordered from rare to frequent and indexed by a second prefix: rare ones
   alone; frequent ones in combinations of two from an extended prefix. The prefix is extended so
   that a linking pair shares one more frequent shingle than there are bins, so some bin holds two.
4. Classes that share a key are verified on their full sets, first against the key's most central
   class only, its hub. What links is one component, so a group of thousands of copies costs one
   comparison each.
5. Of long lists whose classes lie in different components, the index is made anew. A pair shares
   4/9 (n1 + n2) shingles at least, and no more of them lie in the hub than either class shares with
   it: so the two share a shingle outside the hub, and are listed by a prefix of those, or both share
   that many with the hub, and are listed as close to it. Then 4 again; short lists go by all pairs.

Nothing is capped: after the last round the pairs that are left of any list are verified.

A null or empty text, or one without words, has the empty set and links with nothing. Repeated rows
and ties are equal sets. A null id is never the smallest unless a component has no other. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodline.llm.common import stored_rows, unpacked, words
from moodline.operators.lookup import fits_broadcast
from moodline.session import drop_stages, stage, stages_made

SHINGLE = 5
NUM, DEN = 80, 100  # Jaccard similarity of a link, at least
FREQUENT = 256  # classes that share a shingle, over which it is indexed in combinations
PAIRS_PER_ENTRY = 2  # of the first lists: go on with hubs while more pairs than this are left
ROUNDS = 6
LONG = 16  # classes of a list, over which it is indexed anew by what its hub lacks
BLOCK = 1 << 16  # shingles that one verifying group holds, about
CACHE = 100_000  # word hashes kept by a task

_MIX = np.array([xxhash.xxh64_intdigest(f"shingle {k}") | 1 for k in range(SHINGLE)], np.uint64)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = words(text)
        if not tokens:
            return np.zeros(0, np.int64)
        if len(tokens) < SHINGLE:
            return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), len(tokens))], np.uint64).view(np.int64)
        known = self.known
        if len(known) > CACHE:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        h ^= h >> np.uint64(29)
        n = len(h) - SHINGLE + 1
        out = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            out = (out ^ (out >> np.uint64(31))) * _MIX[k] + h[k : n + k]
        out ^= out >> np.uint64(32)
        out *= _MIX[0]
        out ^= out >> np.uint64(29)
        return np.unique(out.view(np.int64))


def shared_least(n):
    """k of step 2."""
    return np.maximum(1, n // 10)


def prefix_size(n: int) -> int:
    return n - -(-NUM * n // DEN) + int(shared_least(n)) if n else 0


def needed(n: int) -> int:
    """What a set of size n shares at least with any it links to."""
    return -(-NUM * n // DEN)


def found_in(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of ``a`` are in ``b``; both sorted."""
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def enough(both: int, a: int, b: int) -> bool:
    return DEN * both >= NUM * (a + b - both)


def links(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    return enough(int(found_in(small, large).sum()), len(a), len(b))


def _sets(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """rid, id, n, sig (of the whole set), prefix."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in batches:
            sets = [shingles(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    pa.array([s[: prefix_size(len(s))] for s in sets], pa.list_(pa.int64())),
                ],
                names=["rid", "id", "n", "sig", "prefix"],
            )

    return rows.select(
        "rid",
        F.col(f"row.`{id_col}`").cast("long").alias("id"),
        F.col(f"row.`{text_col}`").cast("string").alias("text"),
    ).mapInArrow(shingled, "rid long, id long, n long, sig binary, prefix array<long>")


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """Anti-join; a measured small side is broadcast, so wide rows stay where they are."""
    return rows.join(F.broadcast(gone) if fits_broadcast(gone) else gone, key, "left_anti")


def with_only(rows: DataFrame, some: DataFrame, key: str) -> DataFrame:
    return rows.join(F.broadcast(some) if fits_broadcast(some) else some, key, "left_semi")


def _common(rows: DataFrame) -> DataFrame:
    """token, df of the shingles of more than one class."""
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")


def _sharing(prefixes: DataFrame) -> DataFrame:
    """rid of the classes whose prefix shares enough shingles with other classes."""
    spark = prefixes.sparkSession
    # a partner has 0.8 n shingles at least, and k with it
    least = F.greatest(F.lit(1), F.expr(f"n * {NUM} div {DEN * 10}"))
    rows = prefixes.select("rid", "n", F.explode("prefix").alias("token"))
    with stages_made() as made:
        common = stage(_common(rows).select("token"), "join-common")
        found = rows.join(common, "token").groupBy("rid", "n").count()
        out = stage(found.filter(F.col("count") >= least).select("rid"), "join-sharing")
    drop_stages(spark, made[:-1])
    return out


def _shared(sets: DataFrame) -> DataFrame:
    """rid, n, token, df: shingles of more than one class, of classes that share enough."""
    rows = sets.select("rid", F.size("shingles").cast("long").alias("n"), F.explode("shingles").alias("token"))
    common = stage(_common(rows).select("token"), "join-common")
    found = stage(rows.join(common, "token"), "join-shared")
    enough = found.groupBy("rid", "n").count().filter(f"count * {DEN} >= n * {NUM}").select("rid")
    left = stage(found.join(enough, "rid", "left_semi"), "join-left")
    # what left took its shingles along
    return left.join(_common(left), "token")


def keys_of(n: int, df: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Index keys of a class: rare shingles of its prefix, combinations of frequent ones."""
    need, r = needed(n), len(token)
    if r < need:
        return np.zeros(0, np.int64)
    order = np.lexsort((token, df))
    df, token = df[order], token[order]
    first = r - need + 1
    rare = token[:first][df[:first] <= FREQUENT]
    if len(rare) == first or n < 16:
        return token[:first]
    if n < 20:  # meets sets that are too small for combinations
        rare = token[:first]
    own = 1 << ((n // 4).bit_length() - 1)  # bins
    # sizes of linking sets are at most one level apart: near the bottom of a level, take the next too
    levels = (own,) if NUM * n >= DEN * 4 * own else (own, own // 2)
    keys = [rare]
    for bins in levels:
        reach = r - need + bins + 1
        often = token[:reach][df[:reach] > FREQUENT].view(np.uint64)
        place = (often * _MIX[1] >> np.uint64(40)) % np.uint64(bins)
        for b in np.unique(place):
            group = np.sort(often[place == b])
            i, j = np.triu_indices(len(group), 1)
            mixed = (group[i] ^ (group[i] >> np.uint64(30))) * _MIX[2] + group[j]
            mixed = (mixed ^ (mixed >> np.uint64(31))) * _MIX[3] + np.uint64(bins)
            keys.append((mixed ^ (mixed >> np.uint64(33))).view(np.int64))
    return np.concatenate(keys)


def _index(shared: DataFrame) -> DataFrame:
    """key, rid, n, rank: rank orders the classes of a key from central to marginal."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            keys = [
                keys_of(n, np.asarray(df, np.int64), np.asarray(token, np.int64))
                for n, df, token in zip(frame["n"].tolist(), frame["df"], frame["token"], strict=True)
            ]
            size = [len(k) for k in keys]
            # a class all of whose prefix is shared is most likely what others were copied from
            rank = [-1000 * len(f) // n for n, f in zip(frame["n"].tolist(), frame["df"], strict=True)]
            yield pd.DataFrame(
                {
                    "key": np.concatenate(keys) if keys else np.zeros(0, np.int64),
                    "rid": np.repeat(frame["rid"].to_numpy(), size),
                    "n": np.repeat(frame["n"].to_numpy(), size),
                    "rank": np.repeat(np.array(rank, np.int64), size),
                }
            )

    # a class's own prefix: no larger than its text
    lists = shared.groupBy("rid", "n").agg(F.collect_list(F.struct("df", "token")).alias("found"))
    lists = lists.select("rid", "n", F.col("found.df").alias("df"), F.col("found.token").alias("token"))
    rows = stage(lists.mapInPandas(keyed, "key long, rid long, n long, rank long"), "join-keys")
    often = rows.groupBy("key").count().filter("count > 1").select("key")
    return stage(rows.join(often, "key"), "join-index")


MET = "hub long, rid long, n long, common long, linked boolean, outside array<long>"


def _verified(pairs: DataFrame, sets: DataFrame, outside: bool = False) -> DataFrame:
    """hub, rid of the pairs that link; with ``outside`` all pairs as MET, with what rid has and its hub lacks.

    Pairs of a hub are dealt to blocks of bounded size.
    """
    load = pairs.groupBy("hub").agg((F.sum("n") / F.lit(BLOCK) + 1).cast("long").alias("blocks"))
    dealt = pairs.select("hub", "rid").join(load, "hub").select(
        "hub", F.pmod(F.xxhash64("rid"), "blocks").alias("block"), "rid"
    )
    hubs = load.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    rows = dealt.unionByName(hubs.withColumn("rid", F.col("hub"))).join(sets, "rid")

    def verify(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["rid"] == frame["hub"]
        if not own.any() or own.all():
            return frame.iloc[:0][["hub", "rid"]]
        hub = frame.loc[own, "shingles"].iloc[0]
        rest = frame[~own]
        good = [links(hub, s) for s in rest["shingles"]]
        return rest.loc[good, ["hub", "rid"]]

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame["rid"] == frame["hub"]
        hub = frame.loc[own, "shingles"].iloc[0] if own.any() else np.zeros(0, np.int64)
        rest = frame[~own] if len(hub) else frame.iloc[:0]
        inside = [found_in(s, hub) for s in rest["shingles"]]
        n, common = [len(i) for i in inside], [int(i.sum()) for i in inside]
        return pd.DataFrame(
            {
                "hub": rest["hub"],
                "rid": rest["rid"],
                "n": n,
                "common": common,
                "linked": [enough(c, len(hub), m) for c, m in zip(common, n, strict=True)],
                "outside": [s[~i] for s, i in zip(rest["shingles"], inside, strict=True)],
            }
        )

    of = rows.groupBy("hub", "block")
    return of.applyInPandas(meet, MET) if outside else of.applyInPandas(verify, "hub long, rid long")


def components(edges: DataFrame) -> DataFrame:
    """rid, comp: the smallest number reachable, for every node of ``edges`` (a, b).

    Each round every root joins its smallest neighbour, if that is smaller; pointers are shortened
    and edges between the new roots go on.
    """
    edges = stage(edges.select("a", "b").distinct(), "cc-edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    tree = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "rid"), "cc-tree")
    while True:
        while True:  # shorten
            for _ in range(2):
                up = tree.select(F.col("rid").alias("root"), F.col("root").alias("next"))
                tree = tree.join(up, "root").select("rid", F.col("next").alias("root"), F.col("root").alias("was"))
            tree = stage(tree, "cc-tree")
            moved = tree.filter("root <> was").limit(1).count()
            tree = tree.select("rid", "root")
            if not moved:
                break
        left = tree.select(F.col("rid").alias("a"), F.col("root").alias("ra"))
        right = tree.select(F.col("rid").alias("b"), F.col("root").alias("rb"))
        across = stage(
            edges.join(left, "a").join(right, "b").filter("ra <> rb")
            .select(F.least("ra", "rb").alias("low"), F.greatest("ra", "rb").alias("high"))
            .groupBy("high").agg(F.min("low").alias("low")),
            "cc-across",
        )
        if not across.limit(1).count():
            return tree.withColumnRenamed("root", "comp")
        tree = tree.join(across, tree["root"] == across["high"], "left").select(
            "rid", F.coalesce("low", "root").alias("root")
        )


SIZES_FIT = f"least(n, hub_n) * {DEN} >= greatest(n, hub_n) * {NUM}"


def _linked(index: DataFrame, sets: DataFrame) -> DataFrame:
    """rid, comp of every class in ``index``."""
    with stages_made() as made:
        return _linked_by_rounds(index, sets, made)


def _used_up(spark, made: list[str]) -> None:
    """Drops what a finished round doesn't hand on: all but the last components and entries, and the pairs tried."""
    names = ("join-nodes", "join-comps"), ("join-entries",)
    last = [[p for p in made if p.rsplit("/", 1)[1].startswith(n)][-1:] for n in names]
    kept = {p for p in made if "/join-candidates-" in p}.union(*last)
    drop_stages(spark, [p for p in made if p not in kept])
    made[:] = [p for p in made if p in kept]


def _anew(met: DataFrame, ranks: DataFrame, comps: DataFrame) -> DataFrame:
    """key, rid, n, rank, comp: the pairs of ``met`` (MET) classes of a hub that may link, listed anew.

    Only pairs in different components count. ``ranks`` has rid and rank.
    """
    rows = met.join(comps, "rid").join(comps.select(F.col("rid").alias("hub"), F.col("comp").alias("hub_comp")), "hub")
    rows = stage(rows, "join-met")
    tokens = rows.select("hub", "rid", "n", "common", "comp", F.explode("outside").alias("token"))
    of = tokens.groupBy("hub", "token").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    of = of.filter("low <> high").select("hub", "token", "df")
    lists = tokens.join(of, ["hub", "token"]).groupBy("hub", "rid", "n", "common", "comp").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared")
    )
    # any partner shares 0.8 n, at most ``common`` of them in the hub
    least = F.greatest(F.lit(1), F.expr(f"(n * {NUM} + {DEN - 1}) div {DEN} - common"))
    lists = lists.withColumn("prefix", F.size("shared") - least + 1).filter("prefix > 0")
    apart = lists.select("hub", "rid", "n", "comp", F.explode(F.expr("slice(shared, 1, int(prefix))")).alias("x")).select(
        F.xxhash64("hub", "x.token").alias("key"), "rid", "n", "comp"
    )
    # pairs that need nothing outside: n1 + n2 <= reach of both, and one of them did not link with the hub
    reach = F.expr(f"common * {NUM + DEN} div {NUM}")
    rows = rows.withColumn("reach", reach).withColumn("away", F.col("comp") != F.col("hub_comp"))
    rows = rows.withColumn("room", F.col("reach") - F.col("n"))
    bounds = rows.groupBy("hub").agg(
        F.min("n").alias("least_n"),
        F.min(F.when(F.col("away"), F.col("n"))).alias("least_away"),
        F.max(F.when(F.col("away"), F.col("room"))).alias("most_room"),
    )
    close = rows.select("hub", "rid", "n", "comp", "away", "room").join(bounds, "hub").filter(
        "(away and room >= least_n) or (not away and n <= most_room and room >= least_away)"
    )
    close = close.select(F.xxhash64("hub", F.lit("close")).alias("key"), "rid", "n", "comp")
    return apart.unionByName(close).distinct().join(ranks, "rid").select("key", "rid", "n", "rank", "comp")


def _linked_by_rounds(index: DataFrame, sets: DataFrame, made: list[str]) -> DataFrame:
    comps = stage(index.select("rid", F.col("rid").alias("comp")).distinct(), "join-nodes")
    ranks = index.select("rid", "rank").distinct()
    entries = index.withColumn("comp", F.col("rid"))
    checked, bound = None, 0
    for turn in range(ROUNDS + 1):
        lists = entries.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"),
            F.min("comp").alias("low"),
            F.max("comp").alias("high"),
            F.min(F.struct("rank", "rid", "n", "comp")).alias("hub"),
        ).filter("low <> high")
        lists = stage(lists.select("key", "size", F.col("hub.rid").alias("hub")), "join-lists")
        rows, pairs = lists.agg(F.sum("size"), F.sum(F.expr("size * (size - 1.0) / 2"))).first()
        if not rows:
            return comps
        if not turn:
            bound = PAIRS_PER_ENTRY * rows
        last = turn == ROUNDS or pairs <= bound
        if last:  # all pairs that are left, each once
            other = entries.join(lists.select("key"), "key", "left_semi").select(
                "key", F.col("rid").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp")
            )
            pairs = entries.join(other, "key").filter(f"comp < hub_comp and {SIZES_FIT}")
        else:
            pairs = entries.join(lists, "key").filter("rid <> hub")
        pairs = pairs.select("hub", "rid", "n").distinct()
        if last and checked is not None:
            pairs = pairs.join(checked, ["hub", "rid"], "left_anti")
        pairs = stage(pairs, "join-candidates")
        met = stage(_verified(pairs, sets, outside=not last), "join-links")
        new = met if last else met.filter("linked").select("hub", "rid")
        both = [pairs.select("hub", "rid"), pairs.select(F.col("rid").alias("hub"), F.col("hub").alias("rid"))]
        tried = both[0].unionByName(both[1])
        checked = tried if checked is None else checked.unionByName(tried)
        of = [comps.select(F.col("rid").alias(x), F.col("comp").alias(y)) for x, y in (("hub", "a"), ("rid", "b"))]
        across = new.join(of[0], "hub").join(of[1], "rid").filter("a <> b")
        if across.limit(1).count():  # only components that a new link joins change
            joined = components(across)
            joined = joined.select(F.col("rid").alias("comp"), F.col("comp").alias("into"))
            comps = comps.join(joined, "comp", "left")
            comps = stage(comps.select("rid", F.coalesce("into", "comp").alias("comp")), "join-comps")
        if last:
            return comps
        # a hub has met all of its list
        entries = entries.join(lists.select("key", F.col("hub").alias("rid")), ["key", "rid"], "left_anti")
        entries = entries.join(lists.select("key", "hub"), "key").drop("comp").join(comps, "rid")
        entries = stage(entries.select("key", "rid", "n", "rank", "comp", "hub"), "join-left")
        sizes = entries.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.min("comp").alias("low"), F.max("comp").alias("high")
        ).filter("low <> high")
        entries = stage(entries.join(sizes.select("key", "size"), "key"), "join-left")
        long = entries.filter(f"size > {LONG}").select("hub", "rid").distinct()
        anew = _anew(met.join(long, ["hub", "rid"], "left_semi"), ranks, comps)
        entries = entries.filter(f"size <= {LONG}").select("key", "rid", "n", "rank", "comp").unionByName(anew)
        entries = stage(entries, "join-entries")
        _used_up(index.sparkSession, made)
    return comps


def join(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """rid, id, n, first (the row that leads its component), component_id per row of ``stored_rows``.

    ``first`` is the rid of the component's smallest id, of its first row if ids repeat. Of the tables made
    on the way only the two that the result reads are left.
    """
    with stages_made() as made:
        found = _joined(rows, id_col, text_col)
    kept = [p for p in made if "/join-sets-" in p or "/join-heads-" in p]
    drop_stages(rows.sparkSession, [p for p in made if p not in kept])
    return found


def _joined(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    every = stage(_sets(rows, id_col, text_col), "join-sets")
    lead = F.struct(F.col("id").isNull().alias("last"), "id", "rid")
    some = every.filter("n > 0").groupBy("sig").agg(
        F.min(lead).alias("lead"), F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies")
    )
    classes = stage(some.select(F.xxhash64("sig").alias("bucket"), "sig", "lead", "rep", "copies"), "join-classes")
    repeated = classes.filter("copies > 1").select("sig", "rep")
    copies = stage(
        every.select("rid", "sig").join(F.broadcast(repeated) if fits_broadcast(repeated.select("rep")) else repeated, "sig")
        .filter("rid <> rep").select("rid"),
        "join-copies",
    )
    sharing = _sharing(without(every.filter("n > 0").select("rid", "n", "prefix"), copies, "rid"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch in batches:
            sets = pa.array([shingles(t) for t in batch.column(1).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["rid", "shingles"])

    texts = rows.select("rid", F.col(f"row.`{text_col}`").cast("string").alias("text"))
    sets = stage(with_only(texts, sharing, "rid").mapInArrow(whole, "rid long, shingles array<long>"), "join-full")
    with stages_made() as made:
        index = _index(_shared(sets))
    drop_stages(rows.sparkSession, made[:-1])  # the index was the last one
    comps = _linked(index, sets)
    # lead of a component: the least lead of its classes
    member = classes.join(comps, classes["rep"] == comps["rid"]).select("sig", "lead", "comp")
    leads = member.groupBy("comp").agg(F.min("lead").alias("head"))
    moved = member.select("sig", "comp").join(leads, "comp").select("sig", "head")
    heads = stage(
        classes.join(moved, "sig", "left").filter("copies > 1 or head is not null")
        .select("sig", F.coalesce("head", "lead").alias("head")),
        "join-heads",
    )
    return every.select("rid", "id", "n", F.when(F.col("n") > 0, F.col("sig")).alias("sig")).join(
        heads, "sig", "left"
    ).select(
        "rid",
        "id",
        "n",
        F.coalesce("head.rid", "rid").alias("first"),
        F.coalesce("head.id", "id").alias("component_id"),
    )


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    with stages_made() as made:
        rows = stored_rows(docs.select(f"`{id_col}`", f"`{text_col}`"), "join-rows")
    found = join(rows, id_col, text_col)
    drop_stages(docs.sparkSession, made)  # no text is read from here on
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The first row of each component, with all columns."""
    rows = stored_rows(docs, "join-rows")
    with stages_made() as made:
        gone = stage(join(rows, id_col, text_col).filter("first <> rid").select("rid"), "join-gone")
    drop_stages(docs.sparkSession, made[:-1])
    return unpacked(without(rows, gone, "rid"), docs)

"""The mix does not depend on how rows are dealt out; targets against a plain version."""

from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moodline.llm import mixing


def documents(spark):
    rows = [(k % 700, "w " * (k % 37), f"s{k % 3 if k % 5 else 0}", k % 4) for k in range(1500)]
    rows += [(7, "the same words here", "s1", 0)] * 400 + [(None, None, None, 1), (None, "a b", None, 1)] * 30
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang int")


def test_same_mix_in_any_split(spark):
    docs = documents(spark)
    found = [
        Counter(map(tuple, mixing.mix(df, block=block).collect()))
        for block in (32, 4096)
        for df in (docs.coalesce(1), docs.repartition(9), docs.orderBy("lang", "text").repartition(3, "doc_id"))
    ]
    assert found[0] == found[1] == found[2] and found[3] == found[4] == found[5]
    taken = [Counter(map(tuple, mixing.take(docs.repartition(k), block=32).select("doc_id", "text", "source").collect())) for k in (1, 7)]
    assert taken[0] == taken[1]
    for rows in found[::3]:
        for source in {r[2] for r in rows}:
            own = [(r, n) for r, n in rows.items() if r[2] == source]
            total, target = sum(r[4] * n for r, n in own), own[0][0][3]
            assert abs(total - target) <= 40
    assert all(r[4] <= 2 * r[1] for r in found[0])


def plain_targets(sizes, weights, share, most):
    """Water filling with exact numbers: full sources stop, the others share what is left."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: Fraction(weights[k % len(weights)]) for k, s in enumerate(names)}
    wanted = Fraction(share) * sum(sizes.values())
    full: set = set()
    while True:
        rest = [s for s in names if s not in full]
        left = wanted - sum(Fraction(most) * sizes[s] for s in full)
        total = sum((weight[s] for s in rest), Fraction(0))
        over = [s for s in rest if left * weight[s] / total >= Fraction(most) * sizes[s]]
        if not over:
            return {s: Fraction(most) * sizes[s] if s in full else left * weight[s] / total for s in names}
        full |= set(over)


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.text("abcé😀Z", max_size=3) | st.none(), st.integers(0, 400), min_size=1, max_size=9))
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: (r.src, r.target) for r in mixing.targets(df, mixing.WEIGHTS, 1.5, 2.0).collect()}
    want = plain_targets(sizes, mixing.WEIGHTS, 1.5, 2.0)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    assert [got[s][0] for s in order] == list(range(len(order)))
    for s, t in want.items():
        assert got[s][1] == pytest.approx(float(t), abs=1e-6)


def test_the_mix_leaves_texts_where_they_are(spark):
    """The plan has a number and a count a row: measured small, it travels, not the texts."""
    docs = spark.createDataFrame([(k, "w " * (k % 7 + 1), "ab"[k % 2]) for k in range(60)], "doc_id long, text string, source string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if too large to be guessed small
    try:
        plan = mixing.take(docs)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan

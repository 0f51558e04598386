"""Quality scores: each part against a plain version, held-out accuracy, awkward rows."""

from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodline.llm import quality, queries
from moodline.llm.common import fold

SF = Path("/root/testdata/sf0.01")
D = len(quality.STATISTICS)


def test_features_approximate_a_gaussian_kernel():
    draw = np.random.default_rng(3)
    x = draw.standard_normal((40, D))
    fourier = quality.FourierMap.drawn(np.zeros(D), np.ones(D), 20_000)
    z = fourier(x)[:, :-1]
    distance = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-distance / (2 * D))).max() < 0.03


def test_sums_are_those_of_all_rows(spark):
    draw = np.random.default_rng(4)
    x, y, fold_ = draw.standard_normal((300, D)), draw.integers(0, 2, 300), draw.integers(0, 3, 300)
    rows = [(int(k), v.tolist(), float(t)) for k, v, t in zip(fold_, x, y, strict=True)]
    fourier = quality.FourierMap.drawn(x.mean(axis=0), x.std(axis=0), 16)
    df = spark.createDataFrame(rows, "fold int, x array<double>, y double").repartition(7)
    sums = quality.sums_by_fold(df, fourier, 3)
    z = fourier(x)
    for k in range(3):
        own = fold_ == k
        assert np.allclose(sums[k][:, :-1], z[own].T @ z[own]) and np.allclose(sums[k][:, -1], z[own].T @ y[own])
    total = sum(sums.values())
    # ridge regression by its rows: a penalty is as good as more rows
    more = np.sqrt(quality.RIDGE * len(x)) * np.eye(17)
    more[-1, -1] = np.sqrt(1e-9)
    want = np.linalg.lstsq(np.vstack((z, more)), np.concatenate((y, np.zeros(17))), rcond=None)[0]
    assert np.allclose(quality.solve(total[:, :-1], total[:, -1]), want)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(1, 9)), min_size=1, max_size=12))
def test_isotonic_is_the_best_rising_fit(points):
    mean, weight = (np.array(v, float) for v in zip(*points, strict=True))
    n = len(mean)
    # max-min formula of isotonic regression
    average = lambda a, b: (mean[a : b + 1] * weight[a : b + 1]).sum() / weight[a : b + 1].sum()
    want = [max(min(average(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
    place, level = quality.isotonic(np.arange(n, dtype=float), mean, weight)
    assert (np.diff(level) > 0).all() and (np.diff(place) > 0).all()
    assert np.allclose(sorted(set(np.round(want, 9))), sorted(set(np.round(level, 9))))


def test_statistics():
    assert not quality.statistics(b"").any()
    row = dict(zip(quality.STATISTICS, quality.statistics("The cat, the cat!\n\nNo. 9 é".encode()), strict=True))
    assert np.isclose(row["distinct_words"], 1) and np.isclose(row["digits"], 1 / 27)
    assert np.isclose(row["line_ends"], 0.5) and np.isclose(row["exclamations"], 1 / 27)
    assert np.isclose(row["wordless"], 1 / 7) and np.isclose(row["capitalised"], 2 / 7)
    for text in (b" \t\n", b"\x00\xff", b"a" * 10**6, b"a " * 10**5, b"\n" * 1000):
        assert np.isfinite(quality.statistics(text)).all()


def test_awkward_rows(spark):
    good, bad = "The cat sat. It was warm.\n" * 5, "%%% ### &&& $$$ " * 20
    rows = [(i, good if i % 2 else bad, 0.0) for i in range(200)] + [
        (None, good, 0.0), (500, None, 0.0), (501, "", 0.0), (7, good, 1.0), (502, good, 0.0), (503, "x" * 10**6, 0.0)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")  # a name of the result
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(200)] + [(7, None), (8, 5), (9, 1), (None, 1), (10, 0)], "doc_id long, quality int"
    )
    got = quality.classify(docs, labels, F.lit(True)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    of = {r.doc_id: r for r in got}
    assert of[502].predicted == of[None].predicted == 1 and of[2].predicted == 0 and of[500].score == of[501].score
    none = quality.classify(docs, labels.limit(0), F.lit(True)).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 1)}
    one = quality.classify(docs, labels.filter("quality = 1"), F.lit(True)).collect()
    assert all(r.score == 1 for r in one)
    assert quality.classify(docs.limit(0), labels, F.lit(True)).collect() == []


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_held_out_rows(spark):
    got = queries.op12_quality(spark, str(SF)).collect()
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id in marks]
    assert sum(r.predicted == marks[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
    assert all(r.predicted for r in unseen if marks[r.doc_id])

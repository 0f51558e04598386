"""The learned aspect model: features, the objective against numpy, accuracy, shipping."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodline.operators import aspects, scoring
from workload import queries, tables

SF = Path("/root/testdata/sf0.01")

TEXTS = [
    ("I love trump so much today", 2), ("people hate trump, truly", 0), ("trump went home", 1),
    ("They LOVE love what trump does", 2), ("hate hate this trump !!!", 0), ("then trump spoke", 1),
] * 12


def plain_features(text, aspect, width, buckets):
    """Names of the features first, hashed at the end."""
    import re
    import zlib

    written = re.findall(r"\w+|[^\w\s]+", text)
    low, named = [w.lower() for w in written], re.findall(r"\w+|[^\w\s]+", aspect.lower())
    places = [i for i in range(len(low)) if named and low[i : i + len(named)] == named]
    names = []
    for p in places or [None]:
        for i, w in enumerate(low):
            if p is None:
                near = f">{min(i + 1, 3)} "
            elif p - width <= i < p:
                near = f"<{min(p - i, 3)} "
            elif p + len(named) <= i < p + len(named) + width:
                near = f">{min(i - p - len(named) + 1, 3)} "
            else:
                continue
            names += [w, near + w] + (["^"] if len(w) > 1 and written[i].isupper() else [])
    out = np.zeros(buckets)
    for name in names:
        h = zlib.crc32(name.encode())
        out[h % buckets] += 1 if h >> 31 else -1
    size = np.sqrt((out**2).sum())
    return out / size if size else out


@pytest.mark.parametrize(
    "text, aspect",
    [
        ("Well, TRUMP's plan -- the BIG one -- is what Trump wants; trump, trump.", "trump"),
        ("one two three", "absent"), ("", "x"), ("Kamala Harris met kamala, then KAMALA HARRIS!", "kamala harris"),
        ("a " * 500 + "b", "b"), ("é É ß x", "ß"),
    ],
)
def test_features(text, aspect):
    for width, buckets in ((8, 1 << 14), (2, 7)):
        index, value = aspects.window_features(text, aspect, width, buckets)
        dense = np.zeros(buckets)
        dense[index] = value
        assert np.allclose(dense, plain_features(text, aspect, width, buckets)) and (np.diff(index) > 0).all()


def frame(spark):
    rows = [(i, t, y, 1, 0) for i, (t, y) in enumerate(TEXTS)] + [(900, "no one here", 2, 0, 0), (901, None, 1, 1, 0), (902, "trump?", None, 1, 0)]
    return spark.createDataFrame(rows, "id int, textdata string, y int, mentions_trump int, mentions_biden int").repartition(3)


def test_objective_against_numpy(spark):
    df, l2, buckets = frame(spark), 1e-2, 256
    model = aspects.train_aspect_model(df, ["trump", "biden"], F.col("y"), buckets=buckets, l2=l2, steps=300)
    weights, constants = model.sent.value
    x = np.stack([plain_features(t, "trump", aspects.WIDTH, buckets) for t, _ in TEXTS])
    y = np.array([k for _, k in TEXTS])

    def loss(w, b):
        z = x @ w.T + b
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
        g = (p - np.eye(3)[y]) / len(y)
        return -np.log(p[range(len(y)), y]).mean() + l2 / 2 * (w**2).sum(), g.T @ x + l2 * w, g.sum(axis=0)

    value, by_weight, by_constant = loss(weights, constants)
    assert np.isclose(value, model.loss[-1], atol=1e-6)
    assert np.abs(by_weight).max() < 1e-4 and np.abs(by_constant).max() < 1e-4  # the minimum
    logits = model([t for t, _ in TEXTS], "trump")
    assert np.allclose(logits, x @ weights.T + constants)


def test_labels_mentions(spark):
    df = frame(spark)
    model = aspects.train_aspect_model(df, ["trump", "biden"], F.col("y"))
    out = scoring.label_aspects(df, model, ["trump", "biden"]).collect()
    names = {0: "negative", 1: "neutral", 2: "positive"}
    assert all(r.trump_sentiment_label == names[r.y] for r in out if r.id < 900)
    assert all(r.biden_sentiment_label is None for r in out)
    assert {r.id: r.trump_sentiment_label for r in out}[901] is None


def test_missing_classes(spark):
    df = frame(spark).filter("y in (0, 1) or y is null")
    model = aspects.train_aspect_model(df, ["trump"], F.col("y"))
    assert {int(np.argmax(v)) for v in model([t for t, _ in TEXTS], "trump")} <= {0, 1}
    one = aspects.train_aspect_model(df.filter("y = 0"), ["trump"], F.col("y"))
    assert int(np.argmax(one(["trump"], "trump")[0])) == 0
    with pytest.raises(ValueError, match="no labelled mention"):
        aspects.train_aspect_model(df, ["biden"], F.col("y"))


@pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
def test_query_beats_the_word_table(spark):
    sf = str(SF)
    marks = {r.doc_id: "negative" if r.toxic else ("neutral", "positive")[r.quality] for r in tables.table(spark, sf, "labels").collect()}
    learned, words = (q(spark, sf).collect() for q in (queries.aspect_model, queries.aspect_batch))
    held_out = {r.doc_id for r in learned if r.held_out}

    def right(rows):
        found = [(r[f"{e}_sentiment_label"], marks[r.doc_id]) for r in rows for e in tables.ENTITIES
                 if r.doc_id in held_out and r.doc_id in marks and r[f"{e}_sentiment_label"]]
        return sum(a == b for a, b in found) / len(found)

    assert right(learned) >= 0.75 and right(learned) > right(words) + 0.2

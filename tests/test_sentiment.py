import math
import random
import re

import pytest
from pyspark.sql import functions as F

from moodline.operators import daily, lexicon, scoring

WORDS = {"good": 2.0, "great": 3.0, "bad": -2.5, "awful": -3.0, "fine": 0.5}
FILLER = ["!", "?!", "?", "very", "slightly", "not", "don't", "but", "the", "cat", "'good'", "so", "without"]


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame(list(WORDS.items()), "token string, valence double")


def texts(n=120, seed=3):
    rng = random.Random(seed)
    out = ["", "good", "nothing here", "but good but bad", None]
    for _ in range(n):
        out.append(" ".join(rng.choice([*WORDS, *FILLER]) for _ in range(rng.randint(1, 25))))
    return out


def split(text):
    return [w.strip("'") for w in re.split(r"[^\w']+", text.lower())]


def plain_compound(text, shifters=None):
    if text is None:
        return None
    words = split(text)
    turn = words.index(shifters.contrast) if shifters and shifters.contrast in words else None
    total = 0.0
    for i, word in enumerate(words):
        if word not in WORDS:
            continue
        v = WORDS[word]
        if shifters:
            boost, flip = 0.0, 1.0
            for step, decay in ((1, 1.0), (2, 0.95), (3, 0.9)):
                before = words[i - step] if i >= step else None
                if before in shifters.intensifiers:
                    boost += 0.293 * decay
                elif before in shifters.dampeners:
                    boost -= 0.293 * decay
                if before in shifters.negations:
                    flip *= -0.74
            v = (v + math.copysign(boost, boost * v)) * flip if boost else v * flip
            if turn is not None and i != turn:
                v *= 0.5 if i < turn else 1.5
        total += v
    if shifters and total:
        asked = text.count("?")
        added = 0.292 * min(text.count("!"), 4) + (
            0.96 if asked > 3 else 0.18 * asked if asked > 1 else 0
        )
        total += math.copysign(added, total)
    return round(total / math.sqrt(total * total + 15), 4)


SHIFTERS = lexicon.Shifters(("very", "so", "really"), ("slightly", "hardly"), ("not", "no", "never", "don't"), "but")


def test_rows_of_repeated_and_null_keys(spark, words):
    rows = [(1, "good"), (1, "good"), (1, "bad"), (None, "good"), (None, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    got = [(r["t"], r["score"]) for r in lexicon.score_rows(df, lexicon.compound_scorer(words), "t").collect()]
    one = dict(got)
    assert len(got) == 5 and got.count(("good", one["good"])) == 3
    assert one["good"] > 0 > one["bad"] and one[None] is None


def test_aspect_scorer_can_be_neutral():
    scorer = scoring.LexiconAspectScorer({"good": 1.0, "bad": -1.0, "so": 0.01})
    best = [max(range(3), key=v.__getitem__) for v in scorer(["good", "bad", "so", "nothing of note"], "x")]
    assert best == [2, 0, 1, 1]


def scored(spark, scorer, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, t string").repartition(3)
    out = lexicon.attach_scores(df.select("id"), scorer(df, "id", "t"), "id")
    return [r["score"] for r in out.orderBy("id").collect()]


@pytest.mark.parametrize("shifters", [None, SHIFTERS])
def test_compound(spark, words, shifters):
    values = texts()
    got = scored(spark, lexicon.compound_scorer(words, shifters), values)
    want = [plain_compound(t, shifters) for t in values]
    for text, g, w in zip(values, got, want, strict=True):
        assert (g is None) == (w is None), text
        assert g is None or abs(g - w) < 1.01e-4, text
        assert g is None or -1 <= g <= 1


def test_shifted_examples(spark, words):
    good, very, slightly, no = scored(
        spark,
        lexicon.compound_scorer(words, SHIFTERS),
        ["good", "very good", "slightly good", "not good"],
    )
    assert slightly < good < very and no < 0
    loud, asked = scored(spark, lexicon.compound_scorer(words, SHIFTERS), ["good!", "bad ??"])
    plain, bad = scored(spark, lexicon.compound_scorer(words, SHIFTERS), ["good", "bad ?"])
    assert loud > plain and asked < bad


def test_polarity(spark, words):
    got = scored(spark, lexicon.polarity_scorer(words), ["good bad bad", "cat", None, "fine"])
    assert got == [-1.0, 0.0, None, 0.5]


def test_scores_with_a_large_lexicon(spark, words, monkeypatch):
    values = texts(60)
    want = scored(spark, lexicon.compound_scorer(words), values)
    plain = lexicon.lookup_join
    monkeypatch.setattr(
        lexicon, "lookup_join", lambda *a, **k: plain(*a, **{**k, "max_rows": 1, "salt_buckets": 4})
    )
    got = scored(spark, lexicon.compound_scorer(words), values)
    assert got == want


def mentions(spark):
    data = [
        (1, "great trump", 1, 0),
        (2, "awful both", 1, 1),
        (3, "good nobody", 0, 0),
        (4, None, 1, 0),
        (5, "no word at all", 0, 1),
    ]
    return spark.createDataFrame(data, "id int, textdata string, mentions_a int, mentions_b int")


def test_mention_gate(spark, words):
    out = scoring.score_mentions(
        mentions(spark), lexicon.compound_scorer(words), ["a", "b"]
    )
    assert "textdata" not in out.columns
    got = {
        r["id"]: (r["a_sentiment_label"], r["b_sentiment_label"], r["a_sentiment_score"])
        for r in out.collect()
    }
    assert got[1][:2] == ("positive", "neutral")
    assert got[2][:2] == ("negative", "negative")
    assert got[3] == ("neutral", "neutral", 0.0)
    assert got[4] == ("neutral", "neutral", None)
    assert got[5] == ("neutral", "neutral", 0.0)


def test_aspect_labels_stay_on_their_rows(spark):
    n = 500
    rng = random.Random(5)
    data = [
        (i, rng.choice(["great", "awful", "cat"]), rng.randint(0, 1), rng.randint(0, 1))
        for i in range(n)
    ]
    df = spark.createDataFrame(data, "id int, textdata string, mentions_a int, mentions_b int")
    out = scoring.label_aspects(
        df.repartition(5), scoring.LexiconAspectScorer(WORDS), ["a", "b"], batch_size=7
    )
    # a text without known words is neutral
    label = {"great": "positive", "awful": "negative", "cat": "neutral"}
    got = {r["id"]: (r["a_sentiment_label"], r["b_sentiment_label"]) for r in out.collect()}
    assert got == {i: (label[t] if a else None, label[t] if b else None) for i, t, a, b in data}
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()


def test_aspect_batches_and_prompt(spark):
    df = spark.createDataFrame([("x", 1, 0)] * 9, "textdata string, mentions_a int, mentions_b int")

    def scorer(given, aspect):
        assert len(given) <= 4
        assert all(t == f"[CLS] x [SEP] {aspect} [SEP]" for t in given)
        return [[0.0, 1.0, 0.0]] * len(given)

    out = scoring.label_aspects(df.coalesce(1), scorer, ["a", "b"], batch_size=4, prompt=True)
    assert {tuple(r)[2:] for r in out.collect()} == {("neutral", None)}


def test_long_by_entity(spark, words):
    out = scoring.score_mentions(
        mentions(spark), lexicon.compound_scorer(words), ["a", "b"]
    )
    got = sorted(tuple(r) for r in scoring.long_by_entity(out, ["a", "b"], ["id"]).collect())
    assert got == [
        (1, "a", "positive"),
        (2, "a", "negative"),
        (2, "b", "negative"),
        (4, "a", "neutral"),
        (5, "b", "neutral"),
    ]


def test_summaries(spark, words):
    out = scoring.score_mentions(
        mentions(spark), lexicon.polarity_scorer(words), ["a", "b"]
    )
    got = {r["entity"]: (r["mentions"], r["mean_score"]) for r in daily.entity_summary(out, ["a", "b"]).collect()}
    assert got == {"a": (3, 0.0), "b": (2, -1.5)}
    counts = [tuple(r) for r in daily.label_counts(out.withColumn("id", F.lit(0)), "a").collect()]
    assert counts == [("negative", 1), ("neutral", 1), ("positive", 1)]

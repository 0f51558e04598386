"""Phrases: the automaton and the join against a plain search, and plans without a shuffle."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodline.operators import lexicon, scoring
from moodline.operators.phrases import Matcher

WORDS = st.sampled_from("abc")
ENTRIES = {
    "good": 2.0, "not good": -1.5, "good as new": 3.0, "as new": 0.5, "new": 0.25, "the bomb": 3.0,
    "the bomb the bomb": -1.0, "don't": -0.5, "straße nach": 1.0,
}
SHIFTERS = lexicon.Shifters(("very", "so"), ("slightly",), ("not", "never"), "but")


def plain(words, entries):
    """From left to right, the longest entry at each place."""
    out, i = [], 0
    while i < len(words):
        fits = [e for e in entries if words[i : i + len(e)] == list(e)]
        best = max(fits, key=len, default=None)
        if best:
            out.append((i, len(best), entries[best]))
        i += len(best) if best else 1
    return out


@settings(max_examples=500, deadline=None)
@given(
    st.dictionaries(st.lists(WORDS, min_size=1, max_size=5).map(tuple), st.integers(-8, 8).map(float), max_size=8),
    st.lists(st.sampled_from("abcd"), max_size=40),
)
def test_matches_are_those_of_a_plain_search(entries, words):
    assert Matcher((" ".join(e), v) for e, v in entries.items()).matches(words) == plain(words, entries)


def table(spark, entries=None):
    rows = list((ENTRIES if entries is None else entries).items())
    return spark.createDataFrame(rows, "token string, valence double")


def texts():
    rng = random.Random(11)
    words = [*" ".join(ENTRIES).split(), "very", "not", "but", "slightly", "x", "''", "'good'", "!", "??", "\n", "-", "é"]
    out = ["", None, "good", "GOOD as  NEW", "good, as new", "'the bomb'", "the bomb the bomb the", "''good''", " good ",
           "but not good", "STRASSE straße Straße nach", "a" * 100_000, "not good " * 5000]
    return out + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(150)]


@pytest.mark.parametrize("mean, shifters", [(False, None), (False, SHIFTERS), (True, None)])
def test_in_place_and_by_join_agree(spark, mean, shifters):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts())], "id int, t string").repartition(3)
    small = lexicon.LexiconScorer(table(spark), mean, shifters)
    large = lexicon.LexiconScorer(table(spark), mean, shifters, most=0)
    assert large.in_place("t") is None
    a, b = ({r.id: r.score for r in lexicon.score_rows(df, s, "t").collect()} for s in (small, large))
    assert a == b and a[0] == 0 and a[1] is None and len(a) == len(texts())
    if mean:
        assert a[3] == 3.0 and a[6] == -1.0 and a[9] == -1.5
    empty = lexicon.LexiconScorer(table(spark, {}), mean, shifters)
    for scorer in (empty, lexicon.LexiconScorer(table(spark, {}), mean, shifters, most=-1)):
        assert {r.score for r in lexicon.score_rows(df, scorer, "t").collect()} == {0.0, None}
    assert lexicon.score_rows(df.limit(0), small, "t").collect() == []


def test_a_word_between_does_not_match(spark):
    df = spark.createDataFrame([("good as brand new",), ("good 'as' new",)], "t string")
    got = [r.score for r in lexicon.score_rows(df, lexicon.polarity_scorer(table(spark)), "t").collect()]
    assert got == [1.125, 3.0]


@pytest.mark.parametrize("most", [100, 0])
def test_an_entry_given_twice_is_an_error(spark, most):
    twice = table(spark).unionAll(table(spark, {" the  bomb": 1.0}))
    with pytest.raises(ValueError, match="given twice"):
        lexicon.score_rows(spark.createDataFrame([("x",)], "t string"), lexicon.LexiconScorer(twice, most=most), "t").collect()


def test_scored_on_their_rows(spark):
    df = spark.range(20).select(F.lit("not good").alias("textdata"), F.lit(1).alias("mentions_a"), "id")
    out = scoring.score_mentions(df, lexicon.compound_scorer(table(spark)), ["a"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert {r.a_sentiment_label for r in out.collect()} == {"negative"}


def test_by_join_with_phrases_only(spark):
    """The last word of a text begins no phrase, but that doesn't make the text unreadable."""
    df = spark.createDataFrame([(0, "x y"), (1, "'not' good"), (2, None), (3, "so not"), (4, "")], "id int, t string")
    entries = {"not good": -1.5, "not good at all": -3.0}
    got = []
    for scorer in (lexicon.LexiconScorer(table(spark, entries), True), lexicon.LexiconScorer(table(spark, entries), True, most=0)):
        got.append({r.id: r.score for r in lexicon.score_rows(df, scorer, "t").collect()})
    assert got[0] == got[1] == {0: 0.0, 1: -1.5, 2: None, 3: 0.0, 4: 0.0}


def test_words_that_begin_no_entry_make_no_grams(spark):
    from moodline.operators import phrases

    entries = table(spark, {"a": 1.0, "a b c": 1.0, "b c": 1.0})
    longest = {r.token: r.longest for r in phrases.first_words(entries).collect()}
    assert longest == {"a": 3, "b": 2}
    words = spark.createDataFrame(
        [(0, "a", "b'", "c", 3), (1, "b", "c", "x", 2), (2, "b", None, None, 2), (3, None, None, None, None), (4, "x", "a", "b", None)],
        "place int, token string, after1 string, after2 string, longest int",
    )
    got = [(r.place, r.token) for r in phrases.grams(words, [1, 2, 3], ["after1", "after2"]).collect()]
    assert got == [(0, "a"), (0, "a b"), (0, "a b c"), (1, "b"), (1, "b c"), (2, "b"), (3, None)]

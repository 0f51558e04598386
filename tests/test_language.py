import math
from collections import Counter

import pytest

from moodline.operators import language

TRAIN = [
    ("the cat and the dog", "en"),
    ("that thing with the other", "en"),
    ("le chat et le chien", "fr"),
    ("la chose avec les autres", "fr"),
    ("ignored", "xx"),
]
TEST = ["the other dog", "les autres chiens", "zzz qqq", "12 !", "", None, "x", "été le the"]


def trigrams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = " " + " ".join(letters.split()) + " "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def plain_detect(text):
    if text is None or not trigrams(text):
        return None
    counts = {l: Counter(g for t, k in TRAIN if k == l for g in trigrams(t)) for l in ("en", "fr")}
    size = len({g for c in counts.values() for g in c})
    scores = {
        l: sum(math.log((c[g] + 1) / (sum(c.values()) + size)) for g in trigrams(text))
        for l, c in counts.items()
    }
    return max(sorted(scores), key=lambda l: scores[l])


@pytest.fixture(scope="module")
def profiles(spark):
    df = spark.createDataFrame(TRAIN, "t string, l string")
    return language.build_profiles(df, "t", "l", ["fr", "en"])


def test_profile_counts(spark, profiles):
    got = {(r["lang"], r["gram"]): r["n"] for r in language.profile_table(profiles).collect()}
    want = Counter((k, g) for t, k in TRAIN if k != "xx" for g in trigrams(t))
    assert got == want
    total = sum(n for (l, _), n in want.items() if l == "en") + len({g for _, g in want})
    assert math.isclose(profiles.log_totals["en"], math.log(total))


def test_both_detectors_are_the_plain_definition(spark, profiles):
    df = spark.createDataFrame(list(enumerate(TEST)), "id int, t string").repartition(3)
    joined = {r["id"]: r["language"] for r in language.detect_by_join(df, profiles, "id", "t").collect()}
    detect = language.row_detector(profiles)
    in_row = {r["id"]: r["l"] for r in df.select("id", detect(df["t"]).alias("l")).collect()}
    for i, text in enumerate(TEST):
        assert joined.get(i) == in_row[i] == plain_detect(text), text


def test_flag_with_profiles_too_large_to_send(spark, profiles):
    df = spark.createDataFrame(list(enumerate(TEST)), "id int, t string")
    small = language.flag_language(df, profiles, text="t")
    large = language.flag_language(df, profiles, text="t", max_rows=2)
    want = {i: plain_detect(t) == "en" for i, t in enumerate(TEST)}
    assert {r["id"]: r["is_en"] for r in small.collect()} == want
    assert {r["id"]: r["is_en"] for r in large.collect()} == want

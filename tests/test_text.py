import string

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from moodline.functions import text as X


PLAIN = string.ascii_lowercase + string.digits


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


# text -> what is left of it
CASES = {
    "https://t.co/abc": "",
    "see http://a.b/c?d=e now": "see  now",
    "www.site.org and HTTP://KEPT.com": "and httpkeptcom",
    "@ab\u0301 hello": "hello",
    "#tag_1 #tag2": "tag1 tag2",
    "a b c": "a b c",
    "  padded\u3000\n": "padded",
    "Mixed CASE, with: marks! \u00e9t\u00e9 \U0001f600": "mixed case with marks t",
    "": "",
    "@http://x.y z": "z",
    "line\nbreak\r\ntab\t": "line\nbreak\r\ntab",
    "rt @user_name: it's 5% #Win!!": "rt  its 5 win",
}


def test_clean_text_cases(spark):
    assert column(spark, list(CASES), X.clean_text("t")) == list(CASES.values())
    assert column(spark, [None], X.clean_text("t")) == [None]


alphabet = st.sampled_from(list("aZ09 _@#.:/'-\n\t\x0b\x1c \u00e9\u0301\u3000\U0001f600") + ["http", "www.", "https://"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(alphabet, max_size=25).map("".join), min_size=20, max_size=40))
def test_clean_text_leaves_plain_words(spark, values):
    cleaned = column(spark, values, X.clean_text("t"))
    assert all(c.isspace() or c in PLAIN for text in cleaned for c in text)
    assert all(text == text.strip() for text in cleaned)
    links = [text for text in cleaned if "http" not in text and "www" not in text]
    assert column(spark, links, X.clean_text("t")) == links if links else True


def test_mention_flag(spark):
    values = ["Trump's", "trumps", "_trump", "trumpé", None, "a TRUMP", "trump\nwins", ""]
    assert column(spark, values, X.mention_flag("t", "trump")) == [1, 0, 0, 0, 0, 1, 1, 0]
    phrase = ["Kamala Harris won", "kamala  harris", "akamala harris"]
    assert column(spark, phrase, X.mention_flag("t", "kamala harris")) == [1, 0, 0]


@pytest.mark.parametrize("entity", ["", "a|b", " x", "x)"])
def test_mention_needs_words(entity):
    with pytest.raises(ValueError):
        X.mention_pattern(entity)


def test_compose_text(spark):
    rows = [
        ("T", "about Trumpism", "T . about Trumpism"),
        ("T", "HARRIS", "T . HARRIS"),
        ("T", "nobody", "T"),
        ("T", "   ", "T"),
        ("T", None, "T"),
    ]
    df = spark.createDataFrame(rows, "title string, description string, want string")
    got = df.select(X.compose_text("title", "description", ["trump", "harris"]), "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_prompt(spark):
    got = column(spark, ["a %s b", None], X.aspect_prompt("t", "trump"))
    assert got == ["[CLS] a %s b [SEP] trump [SEP]", None]


def test_tokens(spark):
    values = ["Don't stop, 'now' Été!", "a-b_c", ""]
    assert column(spark, values, X.tokens("t")) == [
        ["don't", "stop", "'now'", "été", ""],
        ["a", "b_c"],
        [""],
    ]


def test_trigrams(spark):
    values = ["Ab c", "x", "12!", "a\U00010428b"]
    assert column(spark, values, X.trigrams("t")) == [
        [" ab", "ab ", "b c", " c "],
        [" x "],
        [],
        [" a\U00010428", "a\U00010428b", "\U00010428b "],
    ]

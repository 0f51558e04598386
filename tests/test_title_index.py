"""Searching the index gives what searching the titles gives, and reads less."""

import random
from datetime import datetime

import pytest

from moodline.sources import articles, title_index

WORDS = "the of president Trump trump's election election, campaign donald DONALD  é été o'neil a_b 9".split(" ")


def rows(n, seed):
    rng = random.Random(seed)
    out = [(None, 1, "en"), ("", 2, "en"), ("of the  president", 3, "en"), ("of the president of the", 4, "de")]
    for i in range(n):
        gaps = (" ", " ", " ", "  ", ", ", "-", "\n")
        text = "".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(rng.randint(1, 9)))
        out.append((text, i, rng.choice(["en", "de"])))
    return [(t, datetime(2024, 1, 1 + i % 28), lang, i) for t, i, lang in out]


def table(spark, n, seed):
    return spark.createDataFrame(rows(n, seed), "title string, published_at timestamp, language string, token int").repartition(3)


SEARCHES = [
    (["president"], ["donald trump"]), (["the", "election"], ["of the", "the of", "été"]), (["a_b", "9"], ["o"]),
    (["the of the"], ["the"]), (["nothing"], ["the"]),
]


def plain(df, words, phrases, **more):
    return sorted(map(repr, articles.search_articles(df, words=words, phrases=phrases, **more).collect()))


def test_same_rows_over_batches(spark, tmp_path):
    path = str(tmp_path / "index")
    first, second = table(spark, 300, 1), table(spark, 200, 2)
    names = [title_index.add_articles(first, path, buckets=7), title_index.add_articles(second, path)]
    assert len(set(names)) == 2
    both, some = first.unionAll(second), 0
    for words, phrases in SEARCHES:
        for more in ({}, {"equals": {"language": "en"}}, {"after": datetime(2024, 1, 5), "before": datetime(2024, 1, 9)}):
            want = plain(both, words, phrases, **more)
            got = title_index.search_index(spark, path, words=words, phrases=phrases, **more)
            assert got.columns == both.columns and sorted(map(repr, got.collect())) == want
            some += len(want)
    assert some > 100
    want = set(plain(both, ["the"], ["of"])) - set(plain(both, ["the"], ["trump", "of the"]))
    got = title_index.search_index(spark, path, words=["the"], phrases=["of"], none_of=["trump", "of the"])
    assert set(map(repr, got.collect())) == want


def test_reads_the_asked_words_only(spark, tmp_path):
    path = str(tmp_path / "index")
    title_index.add_articles(table(spark, 300, 3), path, buckets=16)
    plan = title_index.asked_postings(spark, path, ["election"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(token, [election])" in text or "EqualTo(token,election)" in text
    assert len({r[0] for r in plan.select("bucket").distinct().collect()}) == 1
    scan = next(line for line in text.split("\n") if "PartitionFilters" in line)
    assert "bucket" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_batch_cut_off_does_not_count(spark, tmp_path):
    path = str(tmp_path / "index")
    title_index.add_articles(table(spark, 50, 4), path)
    extra = title_index.occurrences(table(spark, 50, 5).selectExpr("*", "'lost' as _batch", "monotonically_increasing_id() as _row"), "title")
    buckets = title_index._buckets(spark, path)
    extra.selectExpr("*", f"{buckets} as buckets", f"cast(pmod(xxhash64(token), {buckets}) as int) as bucket").write.mode("append").partitionBy("buckets", "bucket").parquet(path + "/postings")
    got = title_index.search_index(spark, path, words=["the"], phrases=["of"])
    assert sorted(map(repr, got.collect())) == plain(table(spark, 50, 4), ["the"], ["of"])


def test_bad_terms(spark, tmp_path):
    path = str(tmp_path / "index")
    title_index.add_articles(table(spark, 5, 4), path)
    for words in (["a  b"], ["a-b"], []):
        with pytest.raises(ValueError):
            title_index.search_index(spark, path, words=words, phrases=["the"])

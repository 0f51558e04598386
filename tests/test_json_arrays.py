"""Arrays read by byte ranges give the records of the whole file, wherever the ranges begin."""

import json
import random

import pytest
from pyspark.sql import types as T

from moodline.sources import files, json_arrays

SCHEMA = (
    T.StructType()
    .add("uuid", "string")
    .add("title", "string")
    .add("tags", T.ArrayType(T.StructType().add("a", "string")))
    .add("n", "long")
)
NASTY = ['}', '{', '"', '\\', '\\"}', '[{"', "},\n{", "é漢😀", " ", "", "]", "a" * 300, ',{"x":1}', "\t\n"]


def records(n, seed=1):
    rng = random.Random(seed)
    text = lambda: "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 4)))
    return [
        {"uuid": str(k), "title": text(), "tags": [{"a": text()} for _ in range(rng.randint(0, 2))], "n": k, "more": {"b": [[{}]]}}
        for k in range(n)
    ]


def rows(found):
    return sorted((r["uuid"], r["title"], [t["a"] for t in r["tags"]], r["n"]) for r in found)


@pytest.fixture
def small_ranges(spark):
    def set_(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield set_
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [97, 1000, 10**7])
@pytest.mark.parametrize("indent", [None, 2])
def test_wherever_ranges_begin(spark, tmp_path, small_ranges, size, indent):
    want = []
    for k, n in enumerate((0, 1, 40)):
        part = records(n, k)
        want += part
        (tmp_path / f"{k}.json").write_text(json.dumps(part, indent=indent, ensure_ascii=bool(k % 2)) + "\n" * k, "utf-8")
    (tmp_path / "empty.json").write_text(" [\n ] ")
    small_ranges(size)
    df = files.read_article_arrays(spark, str(tmp_path), SCHEMA)
    assert rows(df.collect()) == rows(want)
    if size == 97:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 50


def test_nested_and_by_shuffle(spark, tmp_path, small_ranges, monkeypatch):
    news = [{"textdata": t, "timestamp": k, "mentions_a": 1} for k, t in enumerate(NASTY)]
    (tmp_path / "n.json").write_text(json.dumps([news]))
    small_ranges(61)
    monkeypatch.setattr(json_arrays, "fits_broadcast", lambda *_: False)
    got = files.read_nested_arrays(spark, str(tmp_path / "n.json"), ["a"]).collect()
    assert sorted((r.textdata, r.mentions_a) for r in got) == sorted((t, 1) for t in NASTY)


@pytest.mark.parametrize(
    "text",
    [
        '[{"uuid":"1"}', '[{"uuid":"1"}]]', '[{"uuid":"1"} {"uuid":"2"}]', '[{"uuid":"1"}, 5, {"uuid":"2"}]', '{"uuid":"1"}',
        '[{"uuid":"1"}] [{"uuid":"2"}]', '[{"uuid":"1"},]', '[{"uuid":"1}]', '["x"]', "", '[{"uuid":1e}]', '[[{"uuid":"1"}]]',
    ],
)
@pytest.mark.parametrize("size", [7, 10**6])
def test_broken_text_is_an_error(spark, tmp_path, small_ranges, text, size):
    (tmp_path / "x.json").write_text(text)
    small_ranges(size)
    if not text:
        assert files.read_article_arrays(spark, str(tmp_path), SCHEMA).collect() == []
        return
    with pytest.raises(Exception, match="(?i)json|array|malformed"):
        files.read_article_arrays(spark, str(tmp_path), SCHEMA).collect()


def test_pages_by_line(spark, tmp_path, small_ranges):
    lines = [json.dumps({"data": records(3, k)}) for k in range(30)]
    (tmp_path / "p.json").write_text("\n".join(lines))
    small_ranges(500)
    whole, split = (files.read_article_pages(spark, str(tmp_path), SCHEMA, per_line=b) for b in (False, True))
    assert rows(whole.collect()) == rows(split.collect()) and split.rdd.getNumPartitions() > whole.rdd.getNumPartitions()

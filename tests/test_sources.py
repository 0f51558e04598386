import datetime as dt
import json

import pytest

from moodline.operators.models import fit_model
from moodline.plans.preparation import merge_posts
from moodline.sources import articles, files, sinks
from moodline.streaming.pages import collect_pages

HEADER = b"created_at,tweet_id,tweet,likes,user_join_date,user_followers_count,country\n"


def test_posts_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_bytes(
        HEADER
        + b'2020-10-15 00:00:01,1,"two\nlines, ""quoted"" \xff",3.0,2019-01-01 10:00:00,7.0,US\n'
        + b"2020-10-16 00:00:01,2,plain,,,,\n"
    )
    rows = files.read_posts(spark, str(path)).orderBy("row_order").collect()
    assert rows[0]["tweet"] == 'two\nlines, "quoted" �' and rows[0]["likes"] == 3.0
    assert rows[0]["created_at"] == dt.datetime(2020, 10, 15, 0, 0, 1)
    assert rows[1]["tweet_id"] == 2 and rows[1]["likes"] is None


def test_file_order_decides_the_first_copy(spark, tmp_path):
    for name, text in (("a.csv", "first"), ("b.csv", "second")):
        lines = "".join(f"2020-10-15 00:00:01,{i % 5},{text}{i},1,,,\n" for i in range(20))
        (tmp_path / name).write_bytes(HEADER + lines.encode())
    merged = merge_posts({"x": files.read_posts(spark, str(tmp_path), multiline=False)})
    assert {r["tweet_id"]: r["tweet"] for r in merged.collect()} == {i: f"first{i}" for i in range(5)}


def test_lexicon(spark, tmp_path):
    (tmp_path / "lex.txt").write_text("Good\t1.9\t0.9\t[1, 2]\nbad\t-2.5\t0.6\t[3]\n")
    got = {r[0]: r[1] for r in files.read_lexicon(spark, str(tmp_path / "lex.txt")).collect()}
    assert got == {"good": 1.9, "bad": -2.5}


def test_articles_json(spark, tmp_path):
    data = [{"title": "T", "description": None, "published_at": "2024-05-01T10:00:00.000000Z"}]
    (tmp_path / "a.json").write_text(json.dumps(data, indent=4))
    row = files.read_articles(spark, str(tmp_path / "a.json")).first()
    assert row["title"] == "T" and row["published_at"] == dt.datetime(2024, 5, 1, 10)


def test_nested_records(spark, tmp_path):
    one = [{"textdata": "x", "timestamp": 5, "mentions_a": 1}, {"textdata": "y"}]
    (tmp_path / "1.json").write_text(json.dumps([one, [{"textdata": "not in the first"}]]))
    (tmp_path / "2.json").write_text("[[]]")
    got = [tuple(r) for r in files.read_nested_records(spark, str(tmp_path), ["a"]).collect()]
    assert got == [("x", 5, 1), ("y", None, None)]


@pytest.mark.parametrize("indent", [None, 2])
def test_articles_of_every_layout(spark, tmp_path, indent):
    rows = [{"uuid": str(k), "title": f"T{k}", "description": "a\nb"} for k in range(10)]
    (tmp_path / "array.json").write_text(json.dumps(rows[:4], indent=indent))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in rows[4:9]) + "\n")
    (tmp_path / "one.json").write_text(json.dumps(rows[9], indent=indent))
    (tmp_path / "none.json").write_text("")
    got = files.read_articles(spark, str(tmp_path)).collect()
    assert sorted(r["uuid"] for r in got) == [str(k) for k in range(10)]
    assert {r["description"] for r in got} == {"a\nb"}
    per_line = files.read_articles(spark, str(tmp_path / "lines.json"), per_line=True)
    assert per_line.count() == 5


def test_what_is_no_json_is_an_error(spark, tmp_path):
    (tmp_path / "a.json").write_text("[{\"title\": ")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_articles(spark, str(tmp_path)).collect()


def test_articles_are_read_back(spark, tmp_path):
    at = dt.datetime(2024, 5, 1, 10, 0, 0, 123456)
    df = spark.createDataFrame([("1", "T", "d\n2", "s", "en", at)], files.RAW_ARTICLES)
    sinks.write_articles(df, str(tmp_path / "a"))
    assert files.read_articles(spark, str(tmp_path / "a")).collect() == df.collect()
    sinks.write_csv(df, str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c"), df.schema).collect() == df.collect()


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        "cycle,ecwin_chal,model,modeldate,ecwin_inc\n2020,0.7,polls,11/3/2020,0.3\n2020,,polls,11/2/2020,x\n"
    )
    got = [tuple(r) for r in files.read_csv(spark, str(tmp_path), files_schema()).collect()]
    assert got == [("11/3/2020", 0.3, 0.7), ("11/2/2020", None, None)]
    (tmp_path / "t.csv").write_text("cycle,modeldate\n2020,11/3/2020\n")
    with pytest.raises(ValueError, match="ecwin_inc"):
        files.read_csv(spark, str(tmp_path), files_schema())


def files_schema():
    from moodline.schemas import TOPLINES

    return TOPLINES


def test_ids_that_do_not_parse_are_errors(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(HEADER + b"2020-10-15 00:00:01,1.3165e+18,a,1,,,\n")
    with pytest.raises(Exception, match="tweet_id"):
        files.read_posts(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("mark", ["\u2028", "\u2029", "\x85"])
def test_articles_may_hold_other_line_breaks(spark, tmp_path, mark):
    rows = [{"uuid": str(k), "title": f"T{k}", "description": f"a{mark}b" if k == 3 else "x"} for k in range(6)]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf-8")
    got = files.read_articles(spark, str(tmp_path)).collect()
    assert sorted(r["uuid"] for r in got) == list("012345")
    assert {r["uuid"]: r["description"] for r in got}["3"] == f"a{mark}b"
    pages = [{"data": [r]} for r in rows]
    (tmp_path / "lines.json").write_text("\r\n".join(json.dumps(r, ensure_ascii=False) for r in pages), encoding="utf-8", newline="")
    assert files.read_article_pages(spark, str(tmp_path)).count() == 6


@pytest.mark.parametrize("tail", ['\n{"uuid": "5", "ti', "\nx", "]", "}", ' {"uuid": "6"}', ', {"uuid": "6"}', "\r{}\r[]"])
def test_what_follows_a_document_is_an_error(spark, tmp_path, tail):
    error = "MALFORMED_RECORD|more than one JSON value"
    lines = "\n".join(json.dumps({"uuid": str(k)}) for k in range(5))
    for text in (lines, json.dumps([{"uuid": "1"}]), json.dumps({"uuid": "1"}, indent=1)):
        (tmp_path / "a.json").write_text(text + tail, newline="")
        with pytest.raises(Exception, match=error):
            files.read_articles(spark, str(tmp_path)).collect()
    (tmp_path / "a.json").write_text(json.dumps({"data": [{"uuid": "1"}]}, indent=1) + tail, newline="")
    with pytest.raises(Exception, match=error):
        files.read_article_pages(spark, str(tmp_path)).collect()


def test_pages_per_line(spark, tmp_path):
    pages = [{"data": [{"uuid": f"{k}-{i}"} for i in range(k)]} for k in range(4)]
    (tmp_path / "p.json").write_text("\n".join(map(json.dumps, pages)))
    (tmp_path / "q.json").write_text(json.dumps({"meta": 1, "data": [{"uuid": "q"}]}, indent=2))
    assert files.read_article_pages(spark, str(tmp_path)).count() == 7


def write_page(folder, number, titles):
    rows = [{"uuid": f"{number}-{t}", "title": t} for t in titles]
    (folder / f"page{number}.json").write_text(json.dumps({"meta": {"page": number}, "data": rows}))


def test_pages(spark, tmp_path):
    write_page(tmp_path, 0, ["a", "b"])
    write_page(tmp_path, 1, [])
    (tmp_path / "page2.json").write_text('{"meta": {}}')
    got = sorted(r["title"] for r in files.read_article_pages(spark, str(tmp_path)).collect())
    assert got == ["a", "b"]


def test_collector_takes_each_page_once(spark, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    write_page(pages, 0, ["a", "b"])
    collect_pages(spark, str(pages), out, progress, max_files=1)
    write_page(pages, 1, ["c"])
    write_page(pages, 2, [])
    for _ in range(2):
        collect_pages(spark, str(pages), out, progress, max_files=1)
    assert sorted(r["title"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_search(spark):
    day = dt.datetime(2024, 5, 1)
    data = [
        ("1", "The President and Donald Trump", day),
        ("2", "Donald Trump", day),
        ("3", "campaign of kamala harris", day + dt.timedelta(days=1)),
        ("4", "Election: Donald Trumps", day),
        ("5", "election Kamala Harris", dt.datetime(2023, 12, 31)),
        ("6", "election Kamala Harris", dt.datetime(2024, 11, 5)),
        ("7", None, day),
    ]
    df = spark.createDataFrame(data, "uuid string, title string, published_at timestamp")
    assert sorted(r["uuid"] for r in articles.search_articles(df).collect()) == ["1", "3"]
    assert articles.search_articles(df, equals={"uuid": "3"}).count() == 1


def test_params(spark, tmp_path):
    data = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, p_win double")
    fit = fit_model(data, "OLS no intercept")
    path = sinks.write_params(fit, str(tmp_path), "train", "VADER", "1RATIO")
    assert path.endswith("/train/VADER_1RATIO_ols_no_intercept_params")
    row = spark.read.option("header", True).csv(path).first()
    assert row["params"] == "betas" and float(row["x"]) == pytest.approx(2.0)


def test_csv_keeps_awkward_text(spark, tmp_path):
    text = ' lead, "q" \\ and\nnew line '
    df = spark.createDataFrame([(1, text)], "id int, t string")
    sinks.write_csv(df, str(tmp_path / "c"))
    assert files.read_csv(spark, str(tmp_path / "c"), df.schema).first()["t"] == text


def test_partitioned_table_prunes(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 3 AS part")
    sinks.write_table(df, str(tmp_path / "t"), ["part"])
    back = files.read_table(spark, str(tmp_path / "t"), df.schema).filter("part = 1")
    assert back.count() == 3
    assert "PartitionFilters: [isnotnull(part" in back._jdf.queryExecution().executedPlan().toString()


def test_spread(spark):
    df = spark.range(100).coalesce(1)
    assert files.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 16)
    assert files.spread(many).rdd.getNumPartitions() == 16


def test_stage_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from moodline import session

    conf = SimpleNamespace(get=lambda key, default=None: default)

    def fake(master):
        context = SimpleNamespace(master=master, applicationId="app-1", getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=conf, sparkContext=context)

    assert session.checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    own = session.checkpoint_dir(fake("local[2]"))
    assert own == session.checkpoint_dir(fake("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(fake("yarn"))


def test_stage_cuts_lineage(spark):
    from moodline.session import stage

    df = spark.range(5).selectExpr("id", "id * 2 AS twice").filter("id > 1")
    stored = stage(df, "test")
    assert sorted(map(tuple, stored.collect())) == [(2, 4), (3, 6), (4, 8)]
    assert "Range" not in stored._jdf.queryExecution().logical().toString()

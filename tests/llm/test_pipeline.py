"""The pipeline on awkward rows and on no rows, and what it leaves in the shared folder."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from moodline.session import checkpoint_dir

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")


def folder(spark, tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def stage_tables(spark):
    root = Path(checkpoint_dir(spark).removeprefix("file:")) / "moodline"
    return {p.name for p in root.iterdir()} if root.exists() else set()


def test_awkward_rows(spark, tmp_path):
    base = spark.read.parquet(f"{SF}/documents.parquet").withColumns({"rid": F.lit("x"), "row": F.lit(1), "ids": F.lit(2)})
    own = "one two three four five six seven eight nine ten eleven twelve"
    strange = spark.createDataFrame(
        [
            (None, None, None, None, None), (9001, None, None, "src1", 0), (9002, "", "en", None, 0), (9003, " \t", "en", "src1", 2),
            (9004, own, None, None, 1), (9004, own, None, None, 1), (None, own, "en", "src2", 1), (9005, own + " ", "en", "src1", 1),
            (9006, "word " * 60_000, "en", "src3", 300_000),
        ],
        "doc_id long, text string, lang string, source string, n_chars long",
    ).withColumns({"rid": F.lit(None).cast("string"), "row": F.lit(None).cast("int"), "ids": F.lit(None).cast("int")})
    docs = base.unionByName(strange)
    sf, before = folder(spark, tmp_path, docs), stage_tables(spark)
    kept = corpus_pipeline.run(spark, sf).collect()
    names = [*docs.columns, "n_tokens"]
    assert set(names) <= set(kept[0].asDict()) | {"ids"}
    of = {}
    for r in kept:
        of.setdefault(r.doc_id, []).append(r.text)
    # of equal texts the smallest id stays; empty texts have no words for the mix
    assert set(of) >= {9006} and 9005 not in of and None not in of
    assert len(set(of.get(9004, [own]))) == 1 and not {9001, 9002, 9003} & set(of)
    assert all(len(t) <= 2 for t in of.values())
    # what is left: the tables that the result reads
    left = {n.rsplit("-", 1)[0] for n in stage_tables(spark) - before}
    assert left == {"pipeline-3"}


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, docs)).collect() == []

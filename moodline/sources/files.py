"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodline.schemas import LEXICON, RAW_ARTICLES, RAW_POSTS, processed_news
from moodline.sources.json_arrays import array_documents

ROW_ORDER = "row_order"


def with_file_order(df: DataFrame) -> DataFrame:
    """Add ``row_order``, which sorts the rows of a file scan as they stand in the files.

    Sorting is by file, then block, then the row number a task gives out in block
    order, so the result does not depend on which task read which block.
    """
    return df.withColumn(
        ROW_ORDER,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, *, multiline: bool = True, sep: str = ","
) -> DataFrame:
    """CSV with header and doubled quotes. Bytes that are no text become U+FFFD.

    Columns are found by their names in the header: files may have more of them, in any
    order, and a missing one is an error. All files of a path have the same header. A
    whole number (``LongType``: ids, counts) that does not parse is an error too, since
    rows would lose their key; other values that don't parse are null.

    With ``multiline`` quoted line breaks survive and one file is one task: keep the
    files of a large table small and many. Without it files are split.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .option("sep", sep)
        .csv(path)
    )
    missing = [f.name for f in schema if f.name not in raw.columns]
    if missing:
        raise ValueError(f"no columns {missing} in the header of {path}: {raw.columns}")
    return raw.select(*[_typed(f) for f in schema])


def _typed(field: T.StructField) -> Column:
    text = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return text
    value = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.LongType):
        broken = F.concat(F.lit(f"not a whole number in {field.name}: "), text)
        value = F.when(text.isNotNull() & value.isNull(), F.raise_error(broken).cast("long")).otherwise(value)
    return value.alias(field.name)


def read_posts(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """Raw posts of one entity, in file order."""
    return with_file_order(read_csv(spark, path, RAW_POSTS, multiline=multiline))


def read_lexicon(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A lexicon file without header; columns after token and valence are ignored."""
    rows = spark.read.schema(LEXICON).option("sep", sep).option("quote", "").csv(path)
    return rows.select(F.lower("token").alias("token"), "valence").dropna()


FAIL_FAST = {"mode": "FAILFAST"}


END_MARK = "_end_of_document"


def _documents(raw: DataFrame) -> DataFrame:
    """The JSON documents of whole files (``value``): one, or one on each line.

    A file is taken by lines if each of its lines looks like a document of its own. Lines
    end with a line feed; strings may hold any other break as it is.
    """
    text = F.trim(F.regexp_replace("value", "^\ufeff", ""))
    broken = F.rlike(text, F.lit(r"(?dm)^(?!\s*$)(?!\s*[{\[].*[}\]]\s*$)"))
    lines = F.when(broken, F.array(text)).otherwise(F.split(text, "\r?\n"))
    return raw.select(F.explode(lines).alias("document")).filter(F.rlike("document", F.lit("\\S")))


def _records(documents: DataFrame, schema: T.StructType) -> DataFrame:
    """The records of documents that are a record or an array of them, and nothing after that.

    The parser stops after a first value, so a document is read as the first of two. The second
    holds the document's hash: it is found in its place only if the first was all there was.
    """
    marked = T.StructType([*schema.fields, T.StructField(END_MARK, T.StringType())])
    hashed = F.sha2("document", 256)
    single = F.rlike("document", F.lit("^\\s*[{]"))
    listed = F.when(single, F.concat(F.lit("["), "document", F.lit("]"))).otherwise(F.col("document"))
    pair = F.concat(F.lit("["), listed, F.lit(f',[{{"{END_MARK}":"'), hashed, F.lit('"}]]'))
    parsed = documents.select(
        "document",
        hashed.alias("hashed"),
        single.alias("single"),
        F.from_json(pair, T.ArrayType(T.ArrayType(marked)), FAIL_FAST).alias("pair"),
    )
    at_end = F.get(F.get("pair", F.lit(1)), F.lit(0))[END_MARK]
    whole = (F.size("pair") == 2) & (at_end == F.col("hashed")) & (~F.col("single") | (F.size(F.get("pair", F.lit(0))) == 1))
    broken = F.concat(F.lit("more than one JSON value in a document: "), F.substring("document", 1, 200))
    rows = F.when(whole, F.get("pair", F.lit(0))).otherwise(F.raise_error(broken).cast(T.ArrayType(marked)))
    return parsed.select(F.inline(rows)).drop(END_MARK)


def read_articles(
    spark: SparkSession, path: str, schema: T.StructType = RAW_ARTICLES, *, per_line: bool = False
) -> DataFrame:
    """Articles from JSON files that hold an array of records, or one record per line.

    Files are told apart by what they hold, so each is read by one task; ``per_line``
    promises lines, and files are split. Text that is no JSON, or has anything after its
    first value, is an error.
    """
    return _records(_documents(spark.read.text(path, wholetext=not per_line)), schema)


def read_article_arrays(spark: SparkSession, path: str, schema: T.StructType = RAW_ARTICLES) -> DataFrame:
    """Articles from JSON files of any size that hold one array of records each, read by byte ranges.

    Text that is no array of objects, or has anything after it, is an error.
    """
    return _records(array_documents(spark, path), schema)


def read_nested_arrays(spark: SparkSession, path: str, entities: Sequence[str]) -> DataFrame:
    """Processed news from files ``[[{...}, ...]]`` of any size, with one inner array, read by byte ranges."""
    return _records(array_documents(spark, path, level=2), processed_news(entities))


def page_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """The articles of whole files of result pages."""
    page = T.StructType([T.StructField("data", T.ArrayType(schema))])
    return _records(_documents(raw), page).select(F.inline("data"))


def read_article_pages(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_ARTICLES,
    *,
    per_line: bool = False,
) -> DataFrame:
    """Articles from result pages ``{"data": [...]}``, a page per file or per line. ``per_line``
    promises lines, and files are split.

    Empty pages give no rows; text that is no JSON, or has anything after its first value, is
    an error.
    """
    return page_rows(spark.read.text(path, wholetext=not per_line), schema)


def read_nested_records(
    spark: SparkSession, path: str, entities: Sequence[str], *, per_line: bool = False
) -> DataFrame:
    """Processed news from documents ``[[{...}, ...]]``: the records of the inner array.

    A document is a file, or a line if ``per_line``. It cannot be cut, so each is read
    by one task; large tables belong in Parquet or JSON lines.
    """
    record = processed_news(entities)
    nested = T.ArrayType(T.ArrayType(record))
    documents = spark.read.option("wholetext", not per_line).text(path)
    parsed = documents.select(F.from_json("value", nested).alias("_nested"))
    return parsed.select(F.inline(F.get("_nested", F.lit(0))))


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan over all cores, in turn, if it has fewer splits than cores.

    Not by a key: later joins and aggregations shuffle as they would without it.

    For work that costs much more per byte than a shuffle, on tables that come in a few
    small files. A large table has more splits than the cluster has cores and is left
    as it is. Use it on scans only: on other plans, counting splits would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet stage table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)

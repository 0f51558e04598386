"""JSON arrays of records in files larger than a task.

Spark's text reader cuts a file at every ``}`` instead of at line ends, so a file's byte ranges are read by
many tasks. Whether such a cut ends a record depends on all text before it: is it inside a string, and
how deep? A first pass sums up each range for both answers to the first question: by how much the depth
changes, and whether a string is open at its end. These sums, a row a range, are composed in order
and give every range's start. A second pass cuts the records of the ranges out; the parts of a record
that crosses ranges are put together by record.

Every file holds one array of objects (or arrays in each other around them, ``level`` deep) and nothing else.
Anything else is an error, as is a record that is no JSON. An empty array has no records.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moodline.operators.lookup import fits_broadcast
from moodline.session import stage

# Code of this module travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ESCAPED = re.compile(r"\\.", re.DOTALL)


def effect(fragment: str, inside: bool, closed: bool) -> tuple[int, bool]:
    """How a fragment, followed by ``}`` if ``closed``, changes the depth, and whether a string is open after it."""
    parts = _ESCAPED.sub("", fragment).split('"') if "\\" in fragment else fragment.split('"')
    plain = "".join(parts[1 if inside else 0 :: 2])
    inside = inside == (len(parts) % 2 == 1)
    depth = plain.count("{") + plain.count("[") - plain.count("}") - plain.count("]")
    return (depth - 1 if closed and not inside else depth), inside


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): the texts between ``}``, in order within a range."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool]]:
    """(row, last of its range): a range's rows (file, start, fragment, ...) come one after the other."""
    held = None
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if held:
                yield held, held[:2] != row[:2]
            held = row
    if held:
        yield held, True


# The effect of a range that starts outside or inside of a string; "shut" if } follows its last fragment,
# "bare" if none does, which is so at the end of a file.
_SUMS = pa.schema(
    [("file", pa.string()), ("start", pa.int64())]
    + [
        (f"{ending}_{what}_{name}", pa.int64() if what == "depth" else pa.bool_())
        for ending in ("shut", "bare")
        for name in ("outside", "inside")
        for what in ("depth", "open")
    ]
)


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    depth, inside = [0, 0], [False, True]
    for (file, start, fragment), last in _by_range(batches):
        row = {"file": file, "start": start}
        for k, name in enumerate(("outside", "inside")):
            if last:
                for ending, closed in (("shut", True), ("bare", False)):
                    change, after = effect(fragment, inside[k], closed)
                    row |= {f"{ending}_depth_{name}": depth[k] + change, f"{ending}_open_{name}": after}
            change, inside[k] = effect(fragment, inside[k], True)
            depth[k] += change
        if last:
            yield pa.RecordBatch.from_pylist([row], schema=_SUMS)
            depth, inside = [0, 0], [False, True]


def _compose(frame: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each range of a file; a file that ends amid something is an error."""
    frame = frame.sort_values("start")
    depth, inside, out = 0, False, []
    for i, row in enumerate(frame.itertuples(index=False)):
        last = i + 1 == len(frame)
        out.append((row.file, row.start, depth, inside, last))
        way = f"{'bare' if last else 'shut'}_%s_{'inside' if inside else 'outside'}"
        depth, inside = depth + getattr(row, way % "depth"), bool(getattr(row, way % "open"))
    if depth or inside:
        raise ValueError(f"JSON array is not closed: {out[0][0]}")
    return pd.DataFrame(out, columns=["file", "start", "depth", "inside", "at_end"])


def _cutter(level: int, crossing: bool):
    """Whole records of a range, or (``crossing``) its text up to its first and behind its last border."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[str, int, bool, str]] = []
        held: list[str] = []
        depth, inside, borders = 0, False, -1
        for (file, start, fragment, start_depth, start_inside, at_end), last in _by_range(batches):
            if borders < 0:
                depth, inside, borders = start_depth, start_inside, 0
            closed = not (last and at_end)
            change, inside = effect(fragment, inside, closed)
            depth += change
            held.append(fragment + "}" if closed else fragment)
            border = closed and not inside and depth == level
            if border or last:
                if crossing != (border and borders > 0):
                    rows.append((file, start, border, "".join(held)))
                held, borders = [], borders + 1
            if last and border and crossing:
                rows.append((file, start, False, ""))  # nothing behind the last border
            if last:
                borders = -1
            if len(rows) >= 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(_CUT.names, r, strict=True)) for r in rows], schema=_CUT)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_CUT.names, r, strict=True)) for r in rows], schema=_CUT)

    return cut


_CUT = pa.schema([("file", pa.string()), ("start", pa.int64()), ("border", pa.bool_()), ("text", pa.string())])


def array_documents(spark: SparkSession, path: str, level: int = 1) -> DataFrame:
    """(document): the text of each record of the arrays in the files of ``path``, read by byte ranges."""
    fragments = _fragments(spark, path)
    sums = fragments.mapInArrow(_sum_ranges, _ddl(_SUMS))
    # a row a range, and a range is a task's share of a file: a file's ranges are composed in one task
    states = stage(
        sums.groupBy("file").applyInPandas(_compose, "file string, start long, depth long, inside boolean, at_end boolean"),
        "json-ranges",
    )
    names = ["file", "start", "value", "depth", "inside", "at_end"]
    if fits_broadcast(states):
        placed = fragments.join(F.broadcast(states), ["file", "start"]).select(*names)
    else:
        counted = fragments.withColumn("seq", F.monotonically_increasing_id())
        by_range = counted.join(states, ["file", "start"]).repartition("file", "start")
        placed = by_range.sortWithinPartitions("file", "start", "seq").select(*names)
    whole = placed.mapInArrow(_cutter(level, False), _ddl(_CUT)).select("text", F.lit(1).alias("nth"), F.lit(True).alias("record"))
    parts = placed.mapInArrow(_cutter(level, True), _ddl(_CUT))
    # what lies between two borders is one record; the borders of a file's parts are counted in its order
    order = Window.partitionBy("file").orderBy("start", F.col("border").desc())
    before = F.sum(F.col("border").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = parts.withColumn("nth", F.coalesce(before, F.lit(0)))
    part = F.struct("start", (~F.col("border")).alias("after"), "text")
    pieces = F.transform(F.array_sort(F.collect_list(part)), lambda p: p["text"])
    crossing = numbered.groupBy("file", "nth").agg(
        F.array_join(pieces, "").alias("text"), F.bool_or("border").alias("record")
    )
    start = rf"\ufeff?\s*(?:\[\s*){{{level}}}"
    comma = r"\s*,\s*(?=\{)"
    end = rf"\s*(?:\]\s*){{{level}}}"
    first = F.rlike("text", F.lit(rf"^{start}(?=\{{)"))
    body = (
        F.when(F.col("record") & (F.col("nth") == 0) & first, F.regexp_replace("text", rf"^{start}", ""))
        .when(F.col("record") & (F.col("nth") > 0) & F.rlike("text", F.lit(f"^{comma}")), F.regexp_replace("text", f"^{comma}", ""))
        .when(~F.col("record") & (F.col("nth") > 0) & F.rlike("text", F.lit(f"^{end}$")), F.lit(""))
        .when(~F.col("record") & (F.col("nth") == 0) & F.rlike("text", F.lit(rf"^{start}{end}$")), F.lit(""))
        .otherwise(F.raise_error(F.concat(F.lit("no array of records at: "), F.substring("text", 1, 200))))
    )
    # raising comes before the filter: what is no record must not be dropped unseen
    found = whole.unionByName(crossing.select("text", "nth", "record")).select(body.alias("document"))
    return found.filter("document <> ''")

"""CSV in and out, RFC 4180 quoting, never inferred."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedwright.schemas import DEFAULTS, TABLES

_QUOTING = {"quote": '"', "escape": '"', "dateFormat": "yyyy-MM-dd"}
_FORMAT = {"header": True, **_QUOTING}


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files with line breaks inside quotes, each as one text: `record`, and `header` for a file's first.

    Files are read by byte ranges in parallel. A line goes on with a record where an odd number of
    quotes stands before it in its file: those of the ranges before, which are counted first, and
    those before it in its range. Lines are shuffled by range, and only the records at the ends of
    ranges meet by file. Quotes stand around and, doubled, inside quoted fields only. Lines end with
    \\n or \\r\\n; where a file's first does with the latter, it is \\n inside quotes too, as Spark's own reader has it.
    """
    meta = F.col("_metadata")
    place = [meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), F.monotonically_increasing_id().alias("at")]
    lines = spark.read.option("lineSep", "\n").text(path).select("value", *place)
    lines = lines.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))

    ranges = lines.groupBy("file", "start").agg(F.sum("quotes").alias("n"), F.min_by("value", "at").alias("first"))
    file = Window.partitionBy("file")
    before = F.coalesce(F.sum("n").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    returns = F.max(F.when(F.col("start") == 0, F.col("first").endswith("\r"))).over(file)
    ranges = ranges.select("file", "start", before.alias("before"), F.coalesce(returns, F.lit(False)).alias("returns"))

    within = Window.partitionBy("file", "start").orderBy("at")
    so_far = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = ((F.col("before") + F.col("so_far")) % 2 == 0).cast("int")
    placed = lines.join(ranges, ["file", "start"]).withColumn("so_far", so_far)
    number = F.sum(begins).over(within.rowsBetween(Window.unboundedPreceding, 0))
    whole = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), "\n")
    parts = placed.withColumn("number", number).groupBy("file", "start", "number").agg(whole.alias("text"), F.first("returns").alias("returns"))

    # Part 0 of a range goes on with the last record before it, maybe over many ranges.
    last = F.max("number").over(Window.partitionBy("file", "start"))
    parts = parts.withColumn("edge", (F.col("number") == 0) | (F.col("number") == last))
    record = F.sum((F.col("number") > 0).cast("int")).over(file.orderBy("start", "number"))
    pieces = F.sort_array(F.collect_list(F.struct("start", "number", "text")))
    joined = (
        parts.filter("edge")
        .withColumn("record", record)
        .groupBy("file", "record")
        .agg(pieces.alias("pieces"), F.first("returns").alias("returns"))
        .select(
            F.array_join(F.transform("pieces", lambda x: x["text"]), "\n").alias("text"),
            "returns",
            ((F.col("pieces")[0]["start"] == 0) & (F.col("pieces")[0]["number"] == 1)).alias("header"),
        )
    )
    inner = parts.filter("NOT edge").select("text", "returns", ((F.col("start") == 0) & (F.col("number") == 1)).alias("header"))
    text = F.when(F.col("returns"), F.regexp_replace(F.regexp_replace("text", r"\r\z", ""), "\r\n", "\n")).otherwise(F.col("text"))
    return inner.unionByName(joined).select(text.alias("record"), "header").filter("record <> ''")


def _parsed(spark: SparkSession, path: str, schema: T.StructType, multiline: bool, **options: str | bool) -> DataFrame:
    """CSV under a schema; with `multiline` records are put together first and then parsed like the lines of others."""
    if not multiline:
        return spark.read.schema(schema).options(**_FORMAT, **options).csv(path)
    said = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()}
    rows = records(spark, path).filter("NOT header")
    return rows.select(F.from_csv("record", schema.toDDL(), {**_QUOTING, **said}).alias("row")).select("row.*")


def _header(spark: SparkSession, path: str, multiline: bool) -> list[str]:
    """Column names; only the head of a file is read, and with `multiline` that all files have the same is checked."""
    names = spark.read.options(**_FORMAT, multiLine=multiline).csv(path).columns
    if multiline:
        heads = records(spark, path).filter("header").select("record").distinct().limit(2).collect()
        if len(heads) > 1:
            raise ValueError(f"files with different headers at {path}: {heads[0]['record']!r}, {heads[1]['record']!r}")
    return names


def _texts(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in names])


def read_text(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """A CSV with header, every column as text. All files must have the same header."""
    return _parsed(spark, path, _texts(_header(spark, path, multiline)), multiline, enforceSchema=False, mode="FAILFAST")


class Delivered(NamedTuple):
    """A CSV as delivered by others: its rows, and in one row how many have fewer or more fields than the header."""

    feed: DataFrame
    ragged: DataFrame


def stage_delivered(spark: SparkSession, path: str, staged: str, multiline: bool = False) -> Delivered:
    """Parse a delivered CSV once, every column as text, into a table at `staged`.

    A short row is filled with nulls and fields beyond the header are left out; `ragged` counts
    them as short_rows and long_rows. Both are read from the table.
    """
    header = _header(spark, path, multiline)
    names = [f"c{i}" for i in range(len(header))]
    # Without pruning every row is parsed whole, so that its number of fields is looked at.
    parsed = _parsed(spark, path, _texts([*names, "raw"]), multiline, mode="PERMISSIVE", columnNameOfCorruptRecord="raw", columnPruning=False)
    # A row as expected has no raw text.
    separators = F.length(F.regexp_replace(F.regexp_replace("raw", '"(?:[^"]|"")*"', ""), "[^,]", ""))
    rows = parsed.select(*names, (separators + 1 - len(header)).alias("more"))
    rows.write.mode("overwrite").parquet(staged)
    stored = spark.read.schema(rows.schema).parquet(staged)
    ragged = stored.agg(F.count_if(F.col("more") < 0).alias("short_rows"), F.count_if(F.col("more") > 0).alias("long_rows"))
    return Delivered(stored.select(*(F.col(n).alias(c) for n, c in zip(names, header))), ragged)


def read_table(spark: SparkSession, name: str, path: str, multiline: bool = False) -> DataFrame:
    """A source table under its declared schema.

    Columns are matched by header name, in any order. A column that is absent but
    has a default gets it; any other difference is an error, and so is a value that
    does not parse. `multiline` accepts line breaks inside quotes, at the price of a
    shuffle of the lines (`records`).
    """
    schema = TABLES[name]
    declared = {field.name: field for field in schema.fields}
    header = _header(spark, path, multiline)
    defaults = {c: value for c, value in DEFAULTS.get(name, {}).items() if c not in header}
    unknown = [c for c in header if c not in declared]
    absent = [c for c in declared if c not in header and c not in defaults]
    if unknown or absent:
        raise ValueError(f"{name} at {path}: unknown columns {unknown}, missing columns {absent}")
    stored = T.StructType([declared[c] for c in header])
    df = _parsed(spark, path, stored, multiline, enforceSchema=False, mode="FAILFAST")
    return df.withColumns({c: F.lit(value).cast(declared[c].dataType) for c, value in defaults.items()}).select(
        *declared
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Replace `path` by CSV files with header. Nulls and empty strings are empty fields; blanks are kept."""
    df.write.mode("overwrite").options(
        **_FORMAT, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"

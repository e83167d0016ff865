"""CSV records that may hold line breaks inside quotes, read in parallel from split files.

A file is read as lines by as many tasks as it has splits; no task sees a whole file. Each line maps
the state before it (inside quotes or not) to the state after it; such maps are composed as a
prefix sum, inside each split and then over the splits of a file, which gives the true state at
every line without reading in order. Lines of records that span several lines are joined; all others
go straight to the parser.

Only lines with a quote take part in the prefix sum, as rows of a few numbers. A quote opens a field at
its start and closes it at its end; elsewhere it is text. A backslash escapes, and so does a quote
before a quote. A span that makes no fitting record, or is longer than `MAX_LINES`, is no record: its
lines are judged one by one, so a stray quote costs no case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casemart.schema import RAW_COLUMNS
from casemart.sources.raw import LINE_SCHEMA, REJECTED

MAX_LINES = 10_000
HEADER = ",".join(RAW_COLUMNS)
CSV_RECORD = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}
# Marks of a quote at a field's start, at its end, and at both, in a line without other control marks.
OPEN, CLOSE, EITHER = "\x01", "\x02", "\x03"
AT = ["file", "block", "line"]


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, line, value): the splits of a file in order, lines in order inside a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _marks(value: Column) -> Column:
    """The quotes of a line that may open or close a field, in order."""
    start, end = r"(?:(?<=,)|^)", r"(?=,|\r?\z)"
    plain = F.translate(value, OPEN + CLOSE + EITHER, "")
    text = F.regexp_replace(plain, r'(?s)\\.|""', "")
    text = F.regexp_replace(text, f'{start}"{end}', EITHER)
    text = F.regexp_replace(text, f'{start}"', OPEN)
    text = F.regexp_replace(text, f'"{end}', CLOSE)
    return F.regexp_replace(text, f"[^{OPEN}-{EITHER}]", "")


def line_maps(lines: DataFrame) -> DataFrame:
    """(file, block, line, fixed, flip) of lines that may change the state.

    `fixed` is the state that the line sets whatever was before, or null; `flip` turns it then.
    """
    quoted = lines.filter(F.contains("value", F.lit('"'))).select(*AT, _marks(F.col("value")).alias("m"))
    last = F.regexp_extract("m", f"([{OPEN}{CLOSE}]){EITHER}*\\z", 1)
    fixed = F.when(last == OPEN, 1).when(last == CLOSE, 0)
    flip = F.length(F.regexp_extract("m", f"{EITHER}*\\z", 0)) % 2
    return quoted.select(*AT, fixed.alias("fixed"), flip.alias("flip")).filter(
        "fixed is not null or flip = 1"
    )


def _prefix(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add (known, turn): the composed map up to each row sets the state to `turn`, or flips by it."""
    upto = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("_flips", F.sum("flip").over(upto))
    base = F.when(F.col("fixed").isNotNull(), F.struct("fixed", F.col("_flips") - F.col("flip")))
    based = summed.withColumn("_base", F.last(base, ignorenulls=True).over(upto))
    since = F.col("_flips") - F.coalesce(F.col("_base.col2"), F.lit(0))
    return based.select(
        *rows.columns,
        F.col("_base").isNotNull().alias("known"),
        ((F.coalesce(F.col("_base.fixed"), F.lit(0)) + since) % 2).alias("turn"),
    )


def _after(start: Column) -> Column:
    return F.when(F.col("known"), F.col("turn")).otherwise((start + F.col("turn")) % 2)


def spans(lines: DataFrame) -> DataFrame:
    """(file, block, from, to, record): runs of lines inside one split that belong to a record of
    several lines; `record` is its first line."""
    extents = lines.groupBy("file", "block").agg(
        F.min("line").alias("first"), F.max("line").alias("last")
    )
    mapped = _prefix(line_maps(lines), ["file", "block"], "line")
    # One row per split, the splits without a quote among them.
    whole = mapped.groupBy("file", "block").agg(
        F.max_by(F.struct("known", "turn"), "line").alias("end")
    )
    ends = extents.join(whole, ["file", "block"], "left").select(
        "file", "block", "first", "last",
        F.when(F.col("end.known"), F.col("end.turn")).alias("fixed"),
        F.when(F.col("end.known"), 0).otherwise(F.coalesce("end.turn", F.lit(0))).alias("flip"),
    )
    in_order = Window.partitionBy("file").orderBy("block")
    state = _prefix(ends, ["file"], "block").withColumn("after", _after(F.lit(0)))
    starts = state.select(
        "file", "block", "first", "last",
        F.coalesce(F.lag("after").over(in_order), F.lit(0)).alias("start"),
    )
    here = Window.partitionBy("file", "block").orderBy("line")
    turns = (
        mapped.join(starts, ["file", "block"])
        .withColumn("after", _after(F.col("start")))
        .withColumn("before", F.coalesce(F.lag("after").over(here), F.col("start")))
        .filter("before <> after")
    )
    # Openings and closings alternate, so the next turn of an opening is its closing.
    nexts = turns.withColumn("closing", F.lead("line").over(here))
    inside = nexts.filter("after = 1").select(
        "file", "block", F.col("line").alias("from"),
        F.coalesce("closing", "last").alias("to"),
        F.struct("block", "line").alias("record"), F.col("closing").isNull().alias("open"),
    )
    left_open = inside.filter("open").select("file", "block", F.col("record").alias("opened"))
    first_turn = turns.groupBy("file", "block").agg(F.min("line").alias("turned"))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    tails = (
        starts.join(left_open, ["file", "block"], "left")
        .join(first_turn, ["file", "block"], "left")
        .withColumn("record", F.last("opened", ignorenulls=True).over(earlier))
        .filter("start = 1")
        .select("file", "block", F.col("first").alias("from"),
                F.coalesce("turned", "last").alias("to"), "record")
    )
    return inside.drop("open").unionByName(tails)


def _parsed(value: str) -> Column:
    """Raw columns and `_rejected`, which holds a record that does not fit."""
    columns = ", ".join(f"`{f.name}` STRING" for f in LINE_SCHEMA.fields)
    return F.from_csv(value, columns, CSV_RECORD)


def read_raw_records(
    spark: SparkSession, path: str | list[str], with_file: bool = False
) -> DataFrame:
    """Every record of CSV files with a header row; `_rejected` holds one that does not fit.

    `with_file` adds the path of a record's file in the column `file`.
    """
    lines = numbered_lines(spark, path)
    found = spans(lines)
    size = Window.partitionBy("file", "record")
    short = found.withColumn("_n", F.sum(F.col("to") - F.col("from") + 1).over(size)).filter(
        F.col("_n") <= MAX_LINES
    )
    parts = short.select("file", "block", F.explode(F.sequence("from", "to")).alias("line"), "record")
    heads = (
        lines.filter("block = 0")
        .groupBy("file", "block")
        .agg(F.min("line").alias("line"))
        .withColumn("head", F.lit(True))
    )
    # Both are few rows beside the lines; Spark broadcasts them while they are small.
    special = parts.unionByName(heads, allowMissingColumns=True)
    marked = lines.join(special, AT, "left")
    names = F.translate("value", '"\r\ufeff', "")
    body = F.when(
        F.col("head"),
        F.when(names == HEADER, False).otherwise(
            F.raise_error(F.concat(F.lit("header does not have the declared names: "), names))
        ),
    ).otherwise(True)
    marked = marked.filter(body)
    single = marked.filter("record is null").select("file", "value")
    joined = (
        marked.filter("record is not null")
        .groupBy("file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines"))
        .select("file", F.col("lines.value").alias("lines"))
        .withColumn("value", F.array_join("lines", "\n"))
    )
    fits = _parsed("value")[REJECTED].isNull()
    several = joined.select(
        "file", F.explode(F.when(fits, F.array("value")).otherwise(F.col("lines"))).alias("value")
    )
    records = single.unionByName(several).select(
        "file", F.regexp_replace("value", r"\r\z", "").alias("value")
    )
    # A generator's row is parsed once; a filter on the columns of a projection would be moved below
    # it and parse a line again for every column that it names.
    rows = records.filter("value <> ''").select("file", F.inline(F.array(_parsed("value"))))
    return rows.select(*LINE_SCHEMA.names, *(["file"] if with_file else []))

"""The raw layer: every column text, declared schema, no inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from casemart.schema import RAW_SCHEMA

# `multiLine` stays off so that one large uncompressed file is still split over many tasks.
# `enforceSchema=false` compares the header with the declared names, so a file with columns in
# another order is an error instead of values in the wrong place.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false", "encoding": "UTF-8"}

# A line with more or fewer fields than declared is kept whole in this column, never trimmed or
# filled up in silence; its other columns are not to be trusted.
REJECTED = "_rejected"
LINE_SCHEMA = StructType([*RAW_SCHEMA.fields, StructField(REJECTED, StringType())])
LINE_OPTIONS = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED}


def create_raw_table(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Create the raw table if it is absent; an existing one keeps its rows."""
    columns = ", ".join(f"`{f.name}` STRING" for f in RAW_SCHEMA.fields)
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{location}")
    return spark.table(name)


def create_loaded_view(spark: SparkSession, name: str, table_dir: str) -> DataFrame:
    """The raw cases of an incrementally loaded folder under a name of the catalog."""
    columns = ", ".join(f"`{c}`" for c in RAW_SCHEMA.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {columns} FROM parquet.`{table_dir}` "
        f"WHERE {REJECTED} IS NULL"
    )
    return spark.table(name)


def read_raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Every line of CSV files with a header row; `_rejected` holds a line that does not fit."""
    return spark.read.schema(LINE_SCHEMA).options(**LINE_OPTIONS).csv(path)


def _does_not_fit() -> Column:
    """True for lines kept in the reject column.

    Written so that the CSV reader cannot apply it while it parses, before it knows, and with all
    columns in it: a scan for fewer columns would not notice that a line has too many fields.
    """
    kept = F.concat_ws("", REJECTED, *(F.substring(c, 1, 0) for c in RAW_SCHEMA.names))
    return F.length(kept) > 0


def fitting(lines: DataFrame) -> DataFrame:
    """The raw cases among the lines."""
    return lines.filter(~_does_not_fit()).select(*RAW_SCHEMA.names)


def rejected(lines: DataFrame) -> DataFrame:
    """The lines that are no raw case, as they were delivered."""
    return lines.filter(_does_not_fit()).select(F.col(REJECTED).alias("line"))


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw cases from CSV with a header row; empty fields, quoted or not, are NULL.

    Lines that do not fit are not among them: `rejected(read_raw_lines(...))` has those.
    """
    return fitting(read_raw_lines(spark, path))

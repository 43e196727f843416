"""Raw CSV files in and dashboard CSV files out.

Raw files are read with every column as text (header names kept) and typed in
staging.  No ``multiLine``: raw files stay splittable across tasks.

Exports keep every value.  Text is written with backslash escapes for backslash, line feed
and carriage return, NULL as ``\\N`` (which no escaped text can be), so a record is one line
and exports are split across tasks as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from riskmart.schema import CASE_NOTE_TYPES, ddl

RAW_OPTIONS = {"header": "true", "escape": '"', "mode": "PERMISSIVE"}
# Names of what a checked read adds to the header's columns.
RECORD, FILE = "__record", "__file"

# Everything is quoted, blanks stay, empty text is "", and times keep their microseconds.
EXPORT_OPTIONS = {"header": "true", "escape": '"', "nullValue": "\\N", "emptyValue": "", "lineSep": "\n",
                  "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}
IMPORT_OPTIONS = {k: v for k, v in EXPORT_OPTIONS.items() if k != "quoteAll"}
_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header row of a CSV file."""
    return spark.read.options(**RAW_OPTIONS).csv(path).columns


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, named as in the header row; fields beyond the header's are cut."""
    return spark.read.options(**RAW_OPTIONS).csv(path)


def read_raw_checked(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_raw_csv`, with each row's file and, where a record has more or fewer
    fields than the header, the record's whole text."""
    header = read_header(spark, path)
    schema = StructType([StructField(c, StringType()) for c in (*header, RECORD)])
    # the number of fields is compared only where no column is pruned
    rows = (spark.read.options(**RAW_OPTIONS, columnNameOfCorruptRecord=RECORD, columnPruning="false")
            .schema(schema).csv(path))
    return rows.select("*", F.col("_metadata.file_path").alias(FILE))


def _swap(c, old: str, new: str):
    return F.replace(c, F.lit(old), F.lit(new))


def _escaped(c):
    return _swap(_swap(_swap(c, "\\", "\\\\"), "\n", "\\n"), "\r", "\\r")


def _unescaped(c):
    # written text has no line feed, so one can mark the places of backslash pairs meanwhile
    parts = F.split(_swap(c, "\\\\", "\n"), "\n")
    return F.array_join(F.transform(parts, lambda p: _swap(_swap(p, "\\n", "\n"), "\\r", "\r")), "\\")


def export_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a layer for the dashboard as CSV with a header row, a record a line."""
    df.select(*(_escaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                else F.date_format(F.col(f"`{f.name}`"), _TIME).alias(f.name) if isinstance(f.dataType, TimestampType)
                else F.col(f"`{f.name}`") for f in df.schema)
              ).write.mode(mode).options(**EXPORT_OPTIONS).csv(path)


def import_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an exported CSV back with its declared schema."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    rows = spark.read.options(**IMPORT_OPTIONS, timestampFormat=_TIME).schema(schema).csv(path)
    return rows.select(*(_unescaped(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                         else F.col(f"`{f.name}`") for f in schema))


CASE_NOTE_SCHEMA = ddl(CASE_NOTE_TYPES)

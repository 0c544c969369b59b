"""Scans of the source files and the checks made before they are loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagerlens.schemas import FILE_SCHEMAS

FORMATS = {
    "players": "json",
    "sessions": "json",
    "transactions": "csv",
    "affiliates": "csv",
}

# Spark writes milliseconds unless told otherwise; it reads any number of digits.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

# Rows of one compressed file: some tens of MB, which one task reads.
FILE_ROWS = 1_000_000

# The checks of these two also reject a file without rows.
NON_EMPTY = ("players", "sessions")


class SourceError(ValueError):
    """A source file that must not be loaded."""


# Text of a row that can't be read with the dataset's schema; NULL for a good row.
REJECTED = "_rejected"


def parse_file(
    spark: SparkSession, dataset: str, path: str, json_array: bool = False
) -> DataFrame:
    """All rows of a file with their fixed schema, and REJECTED.

    One rule for every format: a row that is malformed, or has a value that is not of its column's
    type, is rejected whole and carries its text; nothing is loaded as NULL that was not.

    JSON is read as one object per line, which Spark can split. `json_array` reads a file that is
    one top-level array; such a file goes to a single task, so it suits small deliveries only.
    """
    schema = FILE_SCHEMAS[dataset]
    if FORMATS[dataset] == "json":
        wide = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
        if json_array:
            return spark.read.schema(wide).json(
                path, multiLine=True, columnNameOfCorruptRecord=REJECTED
            )
        lines = spark.read.text(path).filter(F.trim("value") != "")
        options = {"columnNameOfCorruptRecord": REJECTED, "mode": "PERMISSIVE"}
        return lines.select(F.from_json("value", wide, options).alias("r")).select("r.*")
    # Columns are found by name, whatever their order. All files of a folder must share one
    # header; a file with another one fails the scan instead of shifting its columns.
    header = file_columns(spark, dataset, path)
    by_name = {c.strip(): c for c in header}
    text = spark.read.option("header", True).option("enforceSchema", False)
    whole = [f"`{c}` string" for c in [*header, REJECTED]]
    rows = text.schema(", ".join(whole)).csv(
        path,
        columnNameOfCorruptRecord=REJECTED,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    cells = {
        f.name: F.col(f"`{by_name[f.name]}`") if f.name in by_name else F.lit(None).cast("string")
        for f in schema.fields
    }
    values = {f.name: cells[f.name].try_cast(f.dataType) for f in schema.fields}
    bad = reduce(
        Column.__or__, (cells[n].isNotNull() & values[n].isNull() for n in schema.names)
    )
    line = F.coalesce(F.col(REJECTED), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
    return rows.select(
        *[v.alias(n) for n, v in values.items()],
        F.when(bad | F.col(REJECTED).isNotNull(), line).alias(REJECTED),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(REJECTED).isNull()).drop(REJECTED)


def rejected_rows(parsed: DataFrame, dataset: str) -> DataFrame:
    """dataset and text of each row that was rejected."""
    return parsed.filter(F.col(REJECTED).isNotNull()).select(
        F.lit(dataset).alias("dataset"), F.col(REJECTED).alias("text")
    )


def scan_file(
    spark: SparkSession, dataset: str, path: str, json_array: bool = False
) -> DataFrame:
    """The good rows of a file; see parse_file()."""
    return good_rows(parse_file(spark, dataset, path, json_array))


def file_columns(
    spark: SparkSession, dataset: str, path: str, json_array: bool = False
) -> list[str]:
    """Column names of a file: the CSV header, or the fields of the first JSON object."""
    if FORMATS[dataset] == "csv":
        return spark.read.option("header", True).csv(path).columns
    if json_array:
        return spark.read.option("multiLine", True).json(path).columns
    first = (
        spark.read.text(path)
        .filter(F.trim("value") != "")
        .select(F.json_object_keys("value").alias("names"))
        .first()
    )
    return list(first.names or []) if first else []


def check_file(
    spark: SparkSession, dataset: str, path: str, json_array: bool = False
) -> list[str]:
    """Raise SourceError if a required column is missing, or if a file that must have rows is
    empty. Returns the columns found."""
    found = file_columns(spark, dataset, path, json_array)
    check_columns(dataset, found)
    return found


def check_columns(dataset: str, found: list[str]) -> None:
    if not found and dataset in NON_EMPTY:
        raise SourceError(f"{dataset}: file is empty")
    missing = [c for c in FILE_SCHEMAS[dataset].names if c not in found]
    if missing:
        raise SourceError(f"{dataset}: missing columns {missing}")


def check_added(dataset: str, found: list[str]) -> None:
    """Raise SourceError if a file has columns its schema doesn't know."""
    added = [c for c in found if c.strip() not in FILE_SCHEMAS[dataset].names]
    if added:
        raise SourceError(f"{dataset}: added columns {added}")


def write_file(df: DataFrame, dataset: str, path: str, compression: str | None = None) -> None:
    """Write rows in the dataset's file format: JSON Lines, or CSV with a header.

    A compressed file can't be split when it is read, so none has more than FILE_ROWS rows.
    """
    rows = df.select(*FILE_SCHEMAS[dataset].names)
    out = rows.write.mode("overwrite").option("timestampFormat", TIMESTAMP_FORMAT)
    if compression:
        out = out.option("compression", compression).option("maxRecordsPerFile", FILE_ROWS)
    if FORMATS[dataset] == "json":
        out.option("ignoreNullFields", False).json(path)
    else:
        # Blanks at the ends of a value belong to it.
        out.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)

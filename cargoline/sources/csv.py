"""CSV scans (S1-S4), and a scan that keeps what does not fit.

Options follow the original job: header, separator, ``"`` as quote and
escape, ``multiLine`` on, default PERMISSIVE mode.  Columns bind by position;
``check_header=True`` makes Spark compare the header with the schema names
(``enforceSchema=false``) and fail on a reordered file.

Scale note: ``multiLine`` files cannot be split, so each file is one task;
many files still read in parallel.  ``multiline=False`` lets Spark split a
large file whose fields hold no line breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cargoline.schema import DELIVERY_SCHEMA


def read_csv(
    spark: SparkSession,
    path: str,
    header: bool = True,
    schema: StructType | None = None,
    delimiter: str = ",",
    multiline: bool = True,
    check_header: bool = False,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Scan CSV with an explicit schema, or infer one (an extra pass) when None.

    Without ``timestamp_format`` inference also takes short texts such as
    ``T1`` for times of the current day.
    """
    reader = (
        spark.read.format("csv")
        .option("header", header)
        .option("sep", delimiter)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    if schema is not None:
        reader = reader.schema(schema)
        if check_header and header:
            reader = reader.option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", True)
    return reader.load(path)


def read_csv_with_rejects(
    spark: SparkSession,
    path: str,
    schema: StructType = DELIVERY_SCHEMA,
    header: bool = True,
    delimiter: str = ",",
    multiline: bool = True,
    column: str = "rejected",
) -> DataFrame:
    """The scan of ``schema`` with the raw text of every record that does not fit it in ``column``.

    A record is rejected if a value cannot be read as its column's type, or if it has fewer or more
    fields than the schema; else ``column`` is null.  So a NULL that stands for an empty field differs
    from one that stands for an unreadable value.  Rejected records keep the values that could
    be read; nothing is dropped.  The same scan as ``read_csv``: one pass, no shuffle.
    """
    if column in schema.names:
        raise ValueError(f"the schema has a column {column!r}")
    raw = (
        spark.read.format("csv").option("header", header).option("sep", delimiter).option("quote", '"').option("escape", '"')
        .option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", column)
        .schema(StructType([*schema.fields, StructField(column, StringType())])).load(path)
    )
    # Spark parses only the columns that are asked for, and takes a record's other fields as they are:
    # the verdict must not depend on that, so it refers to every column (a hash is never below the least long).
    whole = F.xxhash64(*schema.names) >= F.lit(-(2**63))
    return raw.withColumn(column, F.when(F.col(column).isNotNull() & whole, F.col(column)))


def read_deliveries(
    spark: SparkSession, path: str, multiline: bool = True, check_header: bool = False
) -> DataFrame:
    """The deliveries file: header, comma, the fixed nine-column schema (S4)."""
    return read_csv(
        spark,
        path,
        header=True,
        schema=DELIVERY_SCHEMA,
        delimiter=",",
        multiline=multiline,
        check_header=check_header,
    )

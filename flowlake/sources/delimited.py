"""Headerless delimited text (the bulk dumps).

Every field is read as text with an explicit all-string schema: no schema
inference pass, and plain (uncompressed) files stay splittable, so a large
dump is read by one task per file split. Quoting is switched off, so a stray
``"`` inside a name cannot swallow the following lines; ragged rows are kept
(short rows null-padded, long rows cut) and can be flagged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField

from ..registry import BULK_LAYOUTS, header_schema

CORRUPT_COLUMN = "_corrupt_record"


def read_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from a header-only CSV (reads the first line only)."""
    return spark.read.option("header", True).option("sep", sep).csv(path).columns


def layouts_from_headers(spark: SparkSession, headers: dict[str, str]) -> dict[str, list[str]]:
    """Bulk file -> column names, read from header-only CSV files; a missing
    header file leaves its bulk file out (that source is then skipped)."""
    from .paths import path_exists

    return {bulk_file: read_header(spark, header_path) for bulk_file, header_path in headers.items()
            if path_exists(spark, header_path) is not False}


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | str,
    sep: str = "|",
    flag_corrupt: bool = False,
) -> DataFrame:
    """Read a headerless delimited file; ``columns`` is a list of names or
    the name of a registered bulk layout (``"itcont.txt"``)."""
    names = BULK_LAYOUTS[columns] if isinstance(columns, str) else list(columns)
    schema = header_schema(names)
    reader = (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", False)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("multiLine", False)
    )
    if flag_corrupt:
        schema = schema.add(StructField(CORRUPT_COLUMN, StringType(), True))
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, sep: str = "|", mode: str = "overwrite",
                    compression: str = "none") -> None:
    """Write rows as headerless delimited text (NULL -> empty field).

    Used to land bulk-shaped files; one output file per partition, which
    with ``compression`` (``gzip``) is read by one task.
    """
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    df.select(line.alias("value")).write.mode(mode).option("compression", compression).text(path)

"""Delimited text files with a header line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def scan_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: StructType | str | None = None,
    header: bool = True,
    infer_schema: bool = False,
    sampling_ratio: float = 1.0,
    fail_fast: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Read delimited text.

    Give a ``schema`` for anything large: inference reads the whole input once more and may type
    the same column differently from one file to the next. With neither, all columns are strings.

    A field that does not fit its type becomes null, unless ``fail_fast`` makes it an error; with a
    schema, ``corrupt_column`` names a text column that receives the whole line of such a record. Only
    the columns that a query uses are converted, so use them all to see every such line.

    With a schema, the header of every file is compared with it as the file is read, so files whose
    columns are in another order are an error, not taken by position.
    """
    if schema is not None and infer_schema:
        raise ValueError("give a schema or ask for inference, not both")
    if corrupt_column is not None and (schema is None or fail_fast):
        raise ValueError("a column for corrupt records needs a schema and no fail_fast")
    reader = spark.read.option("header", header).option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    if corrupt_column is not None:
        fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        names = [f for f in fields.fields if f.name != corrupt_column]
        schema = StructType([*names, StructField(corrupt_column, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        # Files are matched to the schema by position; a header in another order is an error.
        reader = reader.schema(schema).option("enforceSchema", False)
    elif infer_schema:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Write ``df`` as delimited text with a header in every part file."""
    df.write.option("header", True).csv(path)

"""CSV reads. NULL and missing text become the empty string."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from twincheck.functions.columns import blank_nulls
from twincheck.sources.records import read_records

def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: str | T.StructType | None = None,
    *,
    delimiter: str = ",",
    header: bool = True,
    escape: str = '"',
    encoding: str = "UTF-8",
    multi_line: bool = False,
    extra_cells: bool = False,
) -> DataFrame:
    """CSV with a declared schema, or all text if none is given. Quotes within cells are doubled, as RFC 4180 has it.

    ``multi_line`` reads cells with line breaks, one file a task. ``extra_cells`` reads all-text files by
    :func:`read_records`: cells may hold line breaks though files are split, and a column holds whatever a row has beyond
    its header; rows come with their number in the file.
    """
    if extra_cells:
        if schema is not None or not header or escape != '"':
            raise ValueError("extra cells are read of text files with a header and doubled quotes only")
        return read_records(spark, path, delimiter=delimiter, encoding=encoding)
    options = {"sep": delimiter, "header": header, "escape": escape, "encoding": encoding, "multiLine": multi_line}
    reader = spark.read.options(**options)
    if schema is not None:
        return blank_nulls(reader.schema(schema).csv(path))
    return blank_nulls(reader.csv(path))


def read_csv_inferred(spark: SparkSession, path: str | list[str], *, delimiter: str = ",") -> DataFrame:
    """CSV whose types are guessed from the data; costs an extra pass."""
    return spark.read.option("sep", delimiter).option("header", True).option("inferSchema", True).csv(path)

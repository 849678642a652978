"""File inputs: text, delimited text with a column mask, watched folders, table folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def text_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of one or several inputs as column ``value``."""
    return spark.read.text(list(paths))


def delimited(spark: SparkSession, path: str, columns: str, sep: str = ",", mask: str | None = None) -> DataFrame:
    """Typed columns of a delimited file.

    ``columns`` names and types the kept fields in file order; ``mask`` has one digit per field of
    the file, 1 for kept.  Masked fields are never parsed: the CSV scan prunes them.
    """
    kept = T._parse_datatype_string(columns)
    if mask is None:
        return spark.read.csv(path, schema=kept, sep=sep)
    if mask.count("1") != len(kept.fields):
        raise ValueError(f"mask keeps {mask.count('1')} fields, {len(kept.fields)} are typed")
    wanted = iter(kept.fields)
    schema = T.StructType([
        next(wanted) if flag == "1" else T.StructField(f"_skip{i}", T.StringType()) for i, flag in enumerate(mask)])
    return spark.read.csv(path, schema=schema, sep=sep).select(*[f.name for f in kept.fields])


def watch_text(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Lines of all files that are in a folder now or appear later."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def watch_delimited(spark: SparkSession, folder: str, columns: str, sep: str = ",") -> DataFrame:
    return spark.readStream.schema(columns).option("sep", sep).csv(folder)


def table_scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None,
               **options: str) -> DataFrame:
    """Batch read of a table folder; projection and predicate reach the parquet scan."""
    df = spark.read.options(**options).parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def table_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Continuous read of a table folder; the stream's checkpoint location holds the position."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def socket_options(host: str, port: int) -> dict[str, str]:
    return {"host": host, "port": str(port)}


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Newline-separated text from a socket, for trials only: the source cannot be replayed."""
    return spark.readStream.format("socket").options(**socket_options(host, port)).load()

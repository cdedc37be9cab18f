"""Reading and writing: parquet and CSV in, CSV, parquet or one folder per segment out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratascore.operators.schema import clean_columns


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_schema(features: Sequence[str], key: str = "id", label: str | None = "label",
                integers: Sequence[str] = ()) -> T.StructType:
    """Explicit schema of a wide table: long key, int label and flags, double features."""
    fields = [T.StructField(key, T.LongType())]
    if label:
        fields.append(T.StructField(label, T.IntegerType()))
    for name in features:
        kind = T.IntegerType() if name in integers else T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. With a schema the file is read once; without, types are inferred first."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return clean_columns(df)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with a header. One file only on request: it sends every row through one task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_segments(df: DataFrame, path: str, segment: str = "cluster", files_per_segment: int | None = None,
                   key: str = "id", fmt: str = "parquet") -> str:
    """One folder per segment, in one job.

    By default every task writes its own rows, so nothing is shuffled and a segment that holds a
    third of the table is written by all tasks. With ``files_per_segment`` the rows are spread by
    (segment, salt) first, which gives fewer and larger files.
    """
    if files_per_segment:
        salt = F.pmod(F.xxhash64(F.col(key)), F.lit(files_per_segment))
        df = df.repartition(F.col(segment), salt)
    df.write.mode("overwrite").option("header", True).partitionBy(segment).format(fmt).save(path)
    return path

"""What files exist, and what their paths say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid import constants as K
from vitalgrid.functions import paths
from vitalgrid.sources import lines


def scan(spark: SparkSession, root: str) -> DataFrame:
    """Keys and sizes below ``root``; contents are not read.

    Spark leaves out files without content. Placeholders therefore belong to a
    rejects table, not to storage.
    """
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .select(lines.relative_path(F.col("path"), root).alias("path"), F.col("length").alias("size"))
    )


def with_path_columns(df: DataFrame, path: str = "path") -> DataFrame:
    return (
        df.withColumn("patient_id", paths.segment(F.col(path), 0))
        .withColumn("data_type", paths.segment(F.col(path), 1))
        .withColumn("file_name", paths.segment(F.col(path), 2))
    )


def batch_files(df: DataFrame, types=K.DEVICE_TYPES, path: str = "path") -> DataFrame:
    """Only keys of the form patient/type/file with a known type."""
    return with_path_columns(df, path).where(
        F.col("file_name").isNotNull() & F.col("data_type").isin(*types)
    )


def with_suffix(df: DataFrame, *suffixes: str, non_empty: bool = False) -> DataFrame:
    test = F.lit(False)
    for s in suffixes:
        test = test | F.col("path").endswith(s)
    return df.where(test & (F.col("size") > 0)) if non_empty else df.where(test)


def patients(df: DataFrame, reserved=K.RESERVED_FOLDERS) -> DataFrame:
    """Top-level folders, without the reserved ones."""
    first = paths.segment(F.col("path"), 0)
    keep = F.col("path").contains("/")
    for name in reserved:
        keep = keep & ~first.startswith(name)
    return df.where(keep).select(first.alias("patient_id")).distinct()


def stacked_patients(df: DataFrame) -> DataFrame:
    """Second path segment of keys that lie deeper than two."""
    deep = F.size(F.split("path", "/")) > 2
    return df.where(deep).select(paths.segment(F.col("path"), 1).alias("patient_id")).distinct()


def bbi_paths(df: DataFrame) -> DataFrame:
    """Interval files: under a folder so named at level one or two.

    Where no such folder exists at all, any key with ``bbi`` in it.
    """
    low = F.split(F.lower("path"), "/")

    def folder_at(level: int):
        inside = F.size(low) > level + 1
        return inside & F.coalesce(F.get(low, F.lit(level)).contains(K.BBI_FOLDER), F.lit(False))

    in_folder = folder_at(0) | folder_at(1)
    files = with_suffix(df, ".csv", ".csv.gz", non_empty=True)
    folders = df.where(in_folder).select("path")
    anywhere = F.lower("path").contains("bbi") & ~folders.exists()
    return files.where(in_folder | anywhere)


def expected_counts(df: DataFrame, *suffixes: str) -> DataFrame:
    """Files per patient and type in the source listing."""
    return (
        with_suffix(df, *(suffixes or (".csv",)))
        .groupBy("patient_id", "data_type")
        .agg(F.count(F.lit(1)).alias("expected"))
    )

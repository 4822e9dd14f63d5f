"""Typed scans: every column is named in a schema, nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed value: file names of the fold id lists, or the folder of a partitioned write.
FOLD_FILE_PATTERN = r"(?:id_cv|fold=)(\d+)"


def scan_typed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    num: Sequence[str] = (),
    cat: Sequence[str] = (),
    date: Sequence[str] = (),
    fmt: str = "csv",
) -> DataFrame:
    """Read listed columns, then cast: ``num`` to float, ``cat`` to int, ``date`` to date.

    Text files are read as strings under an explicit schema; text that does not
    parse becomes null. NaN becomes null as well.
    """
    if fmt == "csv":
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        raw = spark.read.schema(schema).option("header", True).csv(path)
    else:
        raw = spark.read.format(fmt).load(path).select(*columns)
    casts = {c: F.col(c).try_cast("float") for c in num}
    casts = {c: F.when(~F.isnan(v), v) for c, v in casts.items()}
    casts.update({c: F.col(c).try_cast("int") for c in cat})
    casts.update({c: F.col(c).try_cast("date") for c in date})
    return raw.withColumns(casts) if casts else raw


def write_folds(folds: DataFrame, path: str, key: str = "building_id") -> None:
    """One folder of id files per fold, with a header."""
    folds.select(key, "fold").write.mode("overwrite").partitionBy("fold").option("header", True).csv(path)


def read_folds(spark: SparkSession, path: str, key: str = "building_id", key_type: str = "string") -> DataFrame:
    """Ids of all fold files with the fold number taken from the file path.

    ``path`` may be a glob over ``id_cv0.csv``-style files or a folder written
    by :func:`write_folds`.
    """
    schema = T.StructType([T.StructField(key, T.StringType())])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .csv(path)
        .select(F.col(key).cast(key_type), F.col("_metadata.file_path").alias("__f"))
    )
    return rows.select(key, F.regexp_extract("__f", FOLD_FILE_PATTERN, 1).cast("int").alias("fold"))

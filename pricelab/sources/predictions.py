"""One long prediction table in place of many model output files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Kinds of prediction artifacts.
KINDS = ("cv", "test-kfold", "test-one")

# Files of a model and kind, at most.
FILES_PER_FOLDER = 8

SCHEMA = "building_id bigint, y_true double, y_pred double, model_id int, kind string"


def write_predictions(df: DataFrame, path: str, model_id: int | None = None, kind: str | None = None) -> None:
    """Write predictions by model and kind, so that reads prune folders; what a (model, kind) held before is replaced.

    Rows are dealt by model, kind and a few slices of the id, so a folder gets a few files and no task a whole model.
    """
    out = df
    if model_id is not None:
        out = out.withColumn("model_id", F.lit(model_id))
    if kind is not None:
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        out = out.withColumn("kind", F.lit(kind))
    slices = F.pmod(F.xxhash64("building_id"), F.lit(FILES_PER_FOLDER))
    dealt = out.repartition("model_id", "kind", slices)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_id", "kind").parquet(path)


def read_predictions(spark: SparkSession, path: str, models: Sequence[int], kind: str, schema: str = SCHEMA) -> DataFrame:
    """Predictions of the listed models; model and kind are partition filters."""
    table = spark.read.schema(schema).parquet(path)
    return table.where(F.col("model_id").isin(list(models)) & (F.col("kind") == kind))


def choose_artifact(preds: DataFrame, kfold_models: Sequence[int]) -> DataFrame:
    """Per model: the k-fold test predictions if listed, else those of the full refit."""
    kind = F.when(F.col("model_id").isin(list(kfold_models)), F.lit("test-kfold")).otherwise(F.lit("test-one"))
    return preds.where(F.col("kind") == kind)


def write_submission(df: DataFrame, path: str, key: str = "building_id", value: str = "total_price") -> None:
    df.select(key, value).write.mode("overwrite").option("header", True).csv(path)


def id_ranges(text: Column | str) -> Column:
    """Ids of a list such as ``1-10,12-22`` as an array."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.transform(F.split(c, ","), lambda p: F.split(F.trim(p), "-"))
    return F.flatten(
        F.transform(
            parts,
            lambda p: F.sequence(F.element_at(p, 1).cast("bigint"), F.element_at(p, -1).cast("bigint")),
        )
    )


def expand_id_ranges(df: DataFrame, text: str, name: str = "id") -> DataFrame:
    """One row per id of the range list."""
    return df.withColumn(name, F.explode(id_ranges(text)))

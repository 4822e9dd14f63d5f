"""Fitted encoders, and whole step chains, as one versioned table.

Every encoder is a few parameters and, where it has one, a table of values and
numbers. Rows hold (version, step, kind, col, value, numbers): the row without a
column carries the parameters as JSON, the others the table. A chain is the rows of
its steps, told apart by their names. The table is as large as the encoders' states;
it is written in one job and read back by any session.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelab.encoders.categorical import CategoryEncoder, FrequencyEncoder, MultiLabelEncoder, RareNuller, TargetMeanEncoder, _ColumnTables
from pricelab.encoders.numeric import Imputer, MedianScaler, MinMaxScaler, SkewLog, StandardScaler
from pricelab.encoders.stages import FeatureSteps

VERSION = 1
SCHEMA = "version int, step string, kind string, col string, value string, numbers array<double>"

# Parameters of each kind, and the numbers of a value in its table.
PARAMS = {
    CategoryEncoder: ("mode", "reserve_missing", "cols", "has_missing_code", "n_classes"),
    TargetMeanEncoder: ("parity", "cols", "unknown_rank"),
    MultiLabelEncoder: ("n", "seed", "cols", "n_cols", "unknown_codes"),
    FrequencyEncoder: ("column", "out"),
    RareNuller: ("threshold", "cols"),
    Imputer: ("parity", "values", "rules"),
    StandardScaler: ("cols", "center", "scale"),
    MedianScaler: ("cols", "center", "scale"),
    MinMaxScaler: ("lo", "hi", "cols", "center", "scale"),
    SkewLog: ("limit", "cols", "mins"),
    FeatureSteps: ("num", "cat", "target", "fill", "rare", "rare_threshold", "skewed", "target_encode", "codes", "scale", "parity", "encoded"),
}
NUMBERS = {
    CategoryEncoder: {"code": "bigint"},
    TargetMeanEncoder: {"mean": "double", "rank": "bigint"},
    FrequencyEncoder: {"n": "bigint"},
}
# Steps of a chain by attribute; those that were not fitted are left out.
STEPS = ("rare_nuller", "target_encoder", "code_encoder", "imputer", "skew_log", "scaler", "target_scaler")

_KINDS = {kind.__name__: kind for kind in PARAMS}


def _plain(value: object) -> object:
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple, set, range)):
        return [_plain(v) for v in value]
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if hasattr(value, "item"):
        return value.item()
    raise TypeError(f"{value!r} is no plain parameter of an encoder")


def encoder_state(encoder: object, spark: SparkSession, step: str = "") -> DataFrame:
    """The state table of a fitted encoder or of a :class:`FeatureSteps` chain."""
    kind = type(encoder)
    if kind not in PARAMS:
        raise TypeError(f"{kind.__name__} has no state table")
    params = {name: _plain(list(encoder.rare) if kind is RareNuller and name == "cols" else getattr(encoder, name)) for name in PARAMS[kind]}
    out = spark.createDataFrame([(VERSION, step, kind.__name__, None, json.dumps(params), None)], SCHEMA)
    head = [F.lit(VERSION).alias("version"), F.lit(step).alias("step"), F.lit(kind.__name__).alias("kind")]
    if kind is RareNuller:
        for c, values in encoder.rare.items():
            numbers = F.array(F.col("n").cast("double")).alias("numbers")
            out = out.unionAll(values.select(*head, F.lit(c).alias("col"), F.col("value").cast("string"), numbers))
    elif hasattr(encoder, "tables"):
        numbers = F.col("codes").cast("array<double>") if kind is MultiLabelEncoder else F.array(*[F.col(n).cast("double") for n in NUMBERS[kind]])
        out = out.unionAll(encoder.tables.state.select(*head, "col", "value", numbers.alias("numbers")))
    if kind is FeatureSteps:
        for name in STEPS:
            if hasattr(encoder, name):
                out = out.unionAll(encoder_state(getattr(encoder, name), spark, f"{step}/{name}"))
    return out


def save_encoder(encoder: object, path: str, spark: SparkSession | None = None) -> None:
    encoder_state(encoder, spark or SparkSession.active()).write.mode("overwrite").parquet(path)


def load_encoder(spark: SparkSession, path: str) -> object:
    """The encoder or chain that :func:`save_encoder` wrote; its tables are read when it transforms."""
    return from_state(spark.read.schema(SCHEMA).parquet(path))


def from_state(state: DataFrame) -> object:
    heads = state.where("col IS NULL").select("version", "step", "kind", "value").collect()
    versions = {r["version"] for r in heads}
    if versions != {VERSION}:
        raise ValueError(f"state of version {sorted(versions)}, this is version {VERSION}")
    by_step = {r["step"]: (_KINDS[r["kind"]], json.loads(r["value"])) for r in heads}
    made = {step: _rebuilt(kind, params, state.where((F.col("step") == step) & F.col("col").isNotNull())) for step, (kind, params) in by_step.items()}
    for step, encoder in made.items():
        owner, _, name = step.rpartition("/")
        if name:
            setattr(made[owner], name, encoder)
    return made[""]


def _rebuilt(kind: type, params: dict, rows: DataFrame) -> object:
    out = kind.__new__(kind)
    for name, value in params.items():
        setattr(out, name, value)
    if kind is RareNuller:
        del out.cols
        out.rare = {c: rows.where(F.col("col") == c).select("value", F.get("numbers", F.lit(0)).cast("bigint").alias("n")) for c in params["cols"]}
    elif kind is MultiLabelEncoder:
        out.tables = _ColumnTables(rows.select("col", "value", F.col("numbers").cast("array<bigint>").alias("codes")))
    elif kind in NUMBERS:
        numbers = [F.get("numbers", F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(NUMBERS[kind].items())]
        out.tables = _ColumnTables(rows.select("col", "value", *numbers))
    return out

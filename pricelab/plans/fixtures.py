"""Stand-in tables: transactions, predictions and folds derived from the given Parquet tables.

Each view has a DataFrame form and an SQL form with the same values. The
DataFrame form joins only the tables that the requested columns need.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricelab.functions.calendar import days_since
from pricelab.functions.keys import seeded_bucket
from pricelab.session import stored

# Modulus of the relative error of each stand-in model.
MODEL_MODULI = {1: 41, 2: 17, 3: 29}
MODELS = tuple(MODEL_MODULI)

_FROM_LINEITEM = {"building_area", "txn_floor", "total_floor", "building_complete_dt"}
_FROM_PART = {"land_area", "building_material", "building_type", "parking_price"}
_FROM_CUSTOMER = {"village", "lat", "lon"}
_FROM_NATION = {"town"}
_FROM_REGION = {"city"}

COLUMNS = [
    "building_id", "total_price", "building_area", "land_area", "txn_floor", "total_floor", "txn_dt",
    "building_complete_dt", "building_material", "building_type", "parking_way", "city", "town", "village",
    "lat", "lon", "parking_price", "is_test",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per order in the shape of a property sale.

    Lookups are left joins on unique keys, so leaving one out never changes rows.
    """
    want = list(dict.fromkeys(["building_id", "total_price", *(cols or COLUMNS)]))
    need = set(want)
    o = table(spark, sf_dir, "orders")
    df = o.select(
        F.col("o_orderkey").alias("building_id"),
        F.col("o_totalprice").alias("total_price"),
        days_since("o_orderdate").alias("txn_dt"),
        F.col("o_orderpriority").alias("parking_way"),
        (F.col("o_orderkey") % 5 == 4).alias("is_test"),
        F.col("o_custkey"),
    )
    if need & (_FROM_LINEITEM | _FROM_PART):
        li = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("building_id"))
            .agg(
                F.sum("l_quantity").alias("qty"),
                F.min("l_linenumber").alias("txn_floor"),
                F.max("l_linenumber").alias("total_floor"),
                days_since(F.min("l_shipdate")).alias("building_complete_dt"),
                F.min("l_partkey").alias("pk"),
            )
        )
        df = df.join(li, "building_id", "left").withColumn("building_area", F.coalesce("qty", F.lit(1.0)))
    if need & _FROM_PART:
        p = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("pk"),
            F.col("p_size").cast("double").alias("land_area"),
            F.col("p_brand").alias("building_material"),
            F.col("p_type").alias("building_type"),
            "p_retailprice",
        )
        df = df.join(p, "pk", "left").withColumn(
            "parking_price", F.when(F.col("building_id") % 7 != 0, F.col("p_retailprice"))
        )
    if need & (_FROM_CUSTOMER | _FROM_NATION | _FROM_REGION):
        c = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_mktsegment").alias("village"),
            (F.col("c_acctbal") / F.lit(1000.0)).alias("lat"),
            F.col("c_nationkey").cast("double").alias("lon"),
            "c_nationkey",
        )
        df = df.join(c, "o_custkey", "left")
    if need & (_FROM_NATION | _FROM_REGION):
        # nation and region have a fixed number of rows at every scale.
        n = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("town"), "n_regionkey"
        )
        df = df.join(F.broadcast(n), "c_nationkey", "left")
    if need & _FROM_REGION:
        r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("city"))
        df = df.join(F.broadcast(r), "n_regionkey", "left")
    return df.select(*want)


def stored_transactions(spark: SparkSession, sf_dir: str, cols: Sequence[str] | None = None) -> DataFrame:
    """:func:`transactions` written once, for operators that read their input several times."""
    return stored(transactions(spark, sf_dir, cols))


TXN_SQL = """
li AS (
  SELECT l_orderkey, SUM(l_quantity) AS qty, MIN(l_linenumber) AS lo,
         MAX(l_linenumber) AS hi, MIN(l_shipdate) AS ship, MIN(l_partkey) AS pk
  FROM lineitem GROUP BY l_orderkey),
txn AS (
  SELECT o_orderkey AS building_id, o_totalprice AS total_price,
         COALESCE(qty, 1e0) AS building_area, CAST(p_size AS DOUBLE) AS land_area,
         lo AS txn_floor, hi AS total_floor,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS txn_dt,
         CAST(date_diff('day', DATE '1995-01-01', CAST(ship AS DATE)) AS INTEGER) AS building_complete_dt,
         p_brand AS building_material, p_type AS building_type,
         o_orderpriority AS parking_way,
         r_name AS city, n_name AS town, c_mktsegment AS village,
         c_acctbal / 1e3 AS lat, CAST(c_nationkey AS DOUBLE) AS lon,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE p_retailprice END AS parking_price,
         o_orderkey % 5 = 4 AS is_test
  FROM orders
  LEFT JOIN li ON l_orderkey = o_orderkey
  LEFT JOIN part ON p_partkey = pk
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey)"""


def predictions_wide(spark: SparkSession, sf_dir: str, cols: Sequence[str] = ()) -> DataFrame:
    """Transactions with one prediction column per stand-in model."""
    df = transactions(spark, sf_dir, ["building_id", "total_price", *cols])
    return df.withColumns({f"pred_{m}": _model_price(m) for m in MODELS})


def _model_price(model: int):
    modulus = MODEL_MODULI[model]
    off = F.col("building_id") % modulus - F.lit(modulus // 2)
    return F.col("total_price") * (F.lit(1.0) + off / F.lit(100.0))


def predictions_long(spark: SparkSession, sf_dir: str, cols: Sequence[str] = ()) -> DataFrame:
    """One row per transaction and model."""
    wide = predictions_wide(spark, sf_dir, cols)
    entries = F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(f"pred_{m}").alias("y_pred")) for m in MODELS])
    return wide.select("building_id", F.col("total_price").alias("y_true"), *cols, F.inline(entries))


PRED_SQL = ",\n".join(
    [
        "preds AS (SELECT txn.*"
        + "".join(
            f", total_price * (1e0 + ((building_id % {k}) - {k // 2}) / 1e2) AS pred_{m}" for m, k in MODEL_MODULI.items()
        )
        + " FROM txn)",
        "plong AS ("
        + " UNION ALL ".join(
            f"SELECT building_id, {m} AS model_id, total_price AS y_true, pred_{m} AS y_pred, building_area FROM preds"
            for m in MODELS
        )
        + ")",
    ]
)


def fold_of(k: int = 5, seed: int = 42, key: str = "building_id"):
    return seeded_bucket(seed, key, k)


def fold_sql(k: int = 5, seed: int = 42, key: str = "building_id") -> str:
    return f"CAST(('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT % {k} AS INTEGER)"


def with_txn(body: str, *ctes: str) -> str:
    """SQL over the transactions view, with further named subqueries."""
    return "WITH " + ",\n".join([TXN_SQL, *ctes]) + "\n" + body


def with_preds(body: str, *ctes: str) -> str:
    """:func:`with_txn` with the wide (``preds``) and long (``plong``) predictions."""
    return with_txn(body, PRED_SQL, *ctes)


def hit_sql(y: str = "y_true", p: str = "y_pred") -> str:
    """SQL twin of the packed hit score."""
    return (
        f"(round_even(avg(CASE WHEN abs({p} - {y}) <= 0.1e0 * {y} THEN 1e0 ELSE 0e0 END), 4) * 10000e0"
        f" + (1e0 - avg(abs({p} - {y}) / nullif({y}, 0))))"
    )


def rounded(df: DataFrame, digits: int = 6, cols: Sequence[str] | None = None) -> DataFrame:
    """Round every float column (or the listed ones) for comparison across engines."""
    names = cols or [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in names})

"""Search results, importance tables, ratio tables and saved text logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Shape of a saved search line, ``(('name', value), ...), mean, ..., [fold, fold]``.
LOG_LINE_MARK = "(("
PARAM_PATTERN = r"\('([^']+)', ([^()]+?)\)"
FOLD_LIST_PATTERN = r"\[([^\[\]]*)\]"
MEANS_PATTERN = r"^[,\s]*([^\[]*)"
RECORD_PATTERN = r"(?=\(\()"
HEAD_PATTERN = r"(?s)^(.*?\)\))"
TAIL_PATTERN = r"(?s)^.*?\)\)(.*)$"


def write_results(results: DataFrame, path: str) -> None:
    """Nested results (parameter map, score arrays, histories) as Parquet."""
    results.write.mode("overwrite").parquet(path)


def read_results(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def save_state(state: DataFrame, path: str) -> None:
    state.write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def importance_table(scores: DataFrame, feature: str = "feat", fold: str = "fold", score: str = "score") -> DataFrame:
    """Per feature: mean score and the fold scores in fold order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col(fold), F.col(score)))), lambda s: s[score])
    return scores.groupBy(F.col(feature).alias("feat")).agg(F.avg(score).alias("avg"), ordered.alias("folds"))


def importance_rows(spark: SparkSession, rows: Sequence[tuple[str, float, Sequence[float]]]) -> DataFrame:
    """A saved importance list as a table."""
    data = [(f, float(a), [float(x) for x in s]) for f, a, s in rows]
    return spark.createDataFrame(data, "feat string, avg double, folds array<double>")


def load_ratio_table(ratios: DataFrame, in_group: str = "ratio in group", share: str = "group shares") -> DataFrame:
    """Blend ratio per model: share of its group times its ratio in the group, unknown = 0."""
    filled = ratios.fillna(0.0, subset=[in_group, share])
    return filled.withColumn("all_ratio", F.col(in_group) * F.col(share))


def parse_search_log(lines: DataFrame, text: str = "value", means: Sequence[str] = ("score", "mse", "mae", "mape")) -> DataFrame:
    """Rows of parameters, mean metrics and fold lists from saved log lines.

    Plain text matching, nothing is evaluated; numbers that do not parse are null.
    """
    # A line may hold several records; each begins where a parameter list opens.
    records = lines.where(F.col(text).contains(LOG_LINE_MARK)).select(
        F.explode(F.filter(F.split(F.col(text), RECORD_PATTERN), lambda r: r.contains(LOG_LINE_MARK))).alias("__record")
    )
    line = F.regexp_extract(F.col("__record"), HEAD_PATTERN, 1)
    tail = F.regexp_extract(F.col("__record"), TAIL_PATTERN, 1)
    pairs = F.transform(
        F.regexp_extract_all(line, F.lit(PARAM_PATTERN), 1),
        lambda k, i: F.struct(
            k.alias("k"), F.trim(F.get(F.regexp_extract_all(line, F.lit(PARAM_PATTERN), 2), i), F.lit("' ")).alias("v")
        ),
    )
    numbers = F.filter(F.split(F.trim(F.regexp_extract(tail, MEANS_PATTERN, 1)), r"[,\s]+"), lambda x: x != "")
    lists = F.transform(
        F.regexp_extract_all(tail, F.lit(FOLD_LIST_PATTERN), 1),
        lambda body: F.transform(F.filter(F.split(F.trim(body), r"[,\s]+"), lambda x: x != ""), lambda x: x.try_cast("double")),
    )
    return records.select(
        F.map_from_entries(pairs).alias("params"),
        *[F.get(numbers, F.lit(i)).try_cast("double").alias(m) for i, m in enumerate(means)],
        lists.alias("fold_lists"),
    )


def read_search_log(spark: SparkSession, path: str, means: Sequence[str] = ("score", "mse", "mae", "mape")) -> DataFrame:
    return parse_search_log(spark.read.text(path), "value", means)


def format_search_log(params: dict[str, Column], means: Sequence[Column], folds: Sequence[Column]) -> Column:
    """The line :func:`parse_search_log` reads."""
    pairs = [F.concat(F.lit(f"('{k}', "), v.cast("string"), F.lit(")")) for k, v in params.items()]
    return F.concat(
        F.lit("("), F.concat_ws(", ", *pairs), F.lit(") "),
        F.concat_ws(" ", *[m.cast("string") for m in means]),
        F.lit(" ["), F.concat_ws(", ", *[f.cast("string") for f in folds]), F.lit("]"),
    )

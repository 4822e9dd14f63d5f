"""Tool calls and their results as canonical JSON, in DataFrame functions only.

Calls and results are joined by conversation and identifier. A call may name
another call that it follows; its depth in that order is found by doubling jumps,
so a chain of n calls takes about log2 n joins, and calls on a cycle have none.
Arguments are checked against the schema of the call's tool: they must be a JSON
object with all required fields, of the declared types and no others. The record
is serialised with sorted keys and without blanks.

A repeated call identifier keeps its first call (smallest position, then name and
arguments), a repeated result its first result. Results without a call and calls
without a result are rows of their own, unlinked. Null identifiers link with
nothing, null or empty arguments and unknown tools are invalid, texts of any
length are kept whole. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import written


@dataclass(frozen=True)
class Tool:
    """Field names and SQL types of the arguments; ``required`` must be there and not null."""

    fields: Mapping[str, str]
    required: tuple[str, ...] = ()

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {self.fields[name]}" for name in sorted(self.fields))


def depths(calls: DataFrame) -> DataFrame:
    """``calls`` (conv_id, call_id, after) with ``depth``: 0 without a known call before, null on a cycle."""
    known = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    start = calls.join(
        known, (F.col("conv_id") == F.col("c")) & (F.col("after") == F.col("i")), "left"
    ).select("conv_id", "call_id", F.col("i").alias("up"), F.when(F.col("i").isNotNull(), 1).otherwise(0).cast("long").alias("depth"))
    jump = written(start, "jumps")
    rounds = math.ceil(math.log2(max(2, jump.count()))) + 1
    for _ in range(rounds):
        if jump.where("up IS NOT NULL").isEmpty():
            break
        far = jump.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("up2"), F.col("depth").alias("more"))
        jump = written(
            jump.join(far, (F.col("conv_id") == F.col("c")) & (F.col("up") == F.col("i")), "left").select(
                "conv_id", "call_id", F.col("up2").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "jumps",
        )
    return jump.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _checked(tools: Mapping[str, Tool]) -> tuple[Column, Column]:
    """Whether ``arguments`` fit the tool ``name``, and their canonical JSON (as given where they don't)."""
    valid, text = F.lit(False), F.col("arguments")
    for name, tool in sorted(tools.items()):
        parsed = F.from_json("arguments", tool.ddl)
        keys = F.json_object_keys("arguments")
        ok = F.coalesce(F.size(F.array_except(keys, F.array(*[F.lit(k) for k in tool.fields]))) == 0, F.lit(False))
        for field in sorted(tool.fields):
            value = parsed.getField(field)
            # A field that is there but can't be read as its type comes back null.
            given = F.get_json_object("arguments", f"$.{field}").isNotNull()
            ok = ok & (value.isNotNull() if field in tool.required else (value.isNotNull() | ~given))
        here = F.col("name") == name
        valid = F.when(here, ok).otherwise(valid)
        text = F.when(here & ok, F.to_json(parsed)).otherwise(text)
    return F.coalesce(valid, F.lit(False)), text


def link(calls: DataFrame, results: DataFrame, tools: Mapping[str, Tool]) -> DataFrame:
    """Calls (conv_id, call_id, after, name, arguments, position) with results (conv_id, call_id, content, position).

    One row per call and per result without a call: conv_id, call_id, name, depth,
    linked, valid and the record as ``json``.
    """
    key = ["conv_id", "call_id"]
    named = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    one = named.groupBy(*key).agg(F.min(F.struct("position", "name", "arguments", "after")).alias("c")).select(*key, "c.*")
    rest = calls.where("conv_id IS NULL OR call_id IS NULL").select(*key, "position", "name", "arguments", "after")
    answers = results.where("conv_id IS NOT NULL AND call_id IS NOT NULL").groupBy(*key).agg(
        F.min(F.struct("position", "content")).alias("r")
    ).select(*key, F.col("r.content").alias("content"), F.lit(True).alias("answered"))
    lost = results.where("conv_id IS NULL OR call_id IS NULL").select(*key, "content", F.lit(True).alias("answered"))
    ordered = one.join(depths(one.select(*key, "after")), key)
    both = ordered.withColumn("called", F.lit(True)).join(answers, key, "full_outer")
    both = both.unionByName(rest.withColumn("called", F.lit(True)), allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    valid, arguments = _checked(tools)
    out = both.withColumns({"valid": valid, "canonical": arguments, "linked": F.coalesce(F.col("called") & F.col("answered"), F.lit(False))})
    record = F.to_json(
        F.struct(
            F.col("canonical").alias("arguments"), F.col("call_id").alias("call_id"), F.col("content").alias("content"),
            F.col("conv_id").alias("conv_id"), F.col("depth").alias("depth"), F.col("name").alias("name"),
        )
    )
    return out.select(*key, "name", "depth", "linked", "valid", record.alias("json"))


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations: each user or system turn calls, the assistant's next turn answers."""
    called = lambda t: F.concat_ws("-", F.col("conv_id").cast("string"), t.cast("string"))
    text = F.col("text")
    asks = turns.where("role IN ('user', 'system')").select(
        "conv_id", called(F.col("turn")).alias("call_id"), called(F.col("turn") - 2).alias("after"),
        F.when(F.col("role") == "user", "reply").otherwise("setup").alias("name"),
        F.to_json(F.struct(F.length(text).alias("chars"), text.alias("text"))).alias("arguments"),
        F.col("turn").cast("long").alias("position"),
    )
    answers = turns.where("role = 'assistant'").select(
        "conv_id", called(F.col("turn") - 1).alias("call_id"), text.alias("content"), F.col("turn").cast("long").alias("position")
    )
    return asks, answers

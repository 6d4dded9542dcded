"""Mixing to target weights: token weights raked to marginals, documents sampled by them.

Iterative proportional fitting: tokens are counted per cell (source x language x topic); in each round
the cell weights are scaled so that the sums over sources, then over languages, then over topics meet
their targets. A cell's ratio is its fitted share over its present one. A document is kept with
probability ``min(1, level * ratio)``, where the level makes the expected tokens ``budget`` of all; so
cells that are too small for their share are kept whole and the others make up for it.

Targets are given as shares, or made from the present shares by tempering (a power below one lifts
what is rare). Only DataFrame functions are used. The driver sees totals, never documents or cells.

Defined cases: a null source, language or topic is the value ``(none)``; a null text has no tokens; a
cell without tokens has ratio one; the draw depends on the id alone, so rows that repeat an id are kept
or left together, and a null id draws as the empty id; no documents give none; a value without a
target has target zero, and targets of values that do not occur are left out, the rest scaled to one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chunkloom.llm.common import WORD_PATTERN
from chunkloom.operators.storage import remove, staged

ROUNDS = 10
BUDGET = 0.5
SEED = "mix-1"
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.5}
NONE = "(none)"


def token_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def topic_of(text: str = "text", tokens: str = "tokens") -> Column:
    """The kind of a text by what it holds: the topic where a table has none of its own."""
    held = F.coalesce(F.col(text), F.lit(""))
    return (
        F.when(held.contains("icense") | held.contains("ights reserved"), "legal")
        .when(held.contains("@"), "contact")
        .when(held.contains(" | "), "listing")
        .when(F.col(tokens) < 100, "note")
        .otherwise("prose")
    )


def draw(id_column: str, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the id and the seed: 52 bits of a digest."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / float(16**13)


def tempered(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """``dimension, target``: present shares to a power, scaled to one."""
    sums = cells.groupBy(dimension).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("raw"))
    return _scaled(sums, dimension)


def _scaled(sums: DataFrame, dimension: str) -> DataFrame:
    total = sums.agg(F.sum("raw")).first()[0]
    return sums.select(dimension, (F.col("raw") / F.lit(total or 1.0)).alias("target"))


def raked(
    cells: DataFrame, targets: Mapping[str, DataFrame | float], rounds: int = ROUNDS
) -> DataFrame:
    """``cells`` (dimensions, ``tokens``) with ``share``, whose sums meet the targets.

    A target is a power for tempering or a frame ``dimension, target`` of shares.
    """
    spark = cells.sparkSession
    total = cells.agg(F.sum("tokens")).first()[0]
    held = cells.withColumn("share", F.col("tokens") / F.lit(float(total or 1)))
    goals = {}
    copies = []
    for name, target in targets.items():
        if isinstance(target, (int, float)):
            goal = tempered(cells.where("tokens > 0"), name, float(target))
        else:
            here = cells.where("tokens > 0").select(name).distinct()
            goal = _scaled(target.select(name, F.col("target").alias("raw")).join(here, name), name)
        goals[name], copy = staged(goal, "targets")
        copies.append(copy)
    held, last = staged(held, "raked")
    for _ in range(rounds):
        for name, goal in goals.items():
            sums = held.groupBy(name).agg(F.sum("share").alias("sum")).join(goal, name, "left")
            scale = sums.select(name, F.coalesce(F.try_divide("target", "sum"), F.lit(0.0)).alias("scale"))
            held, copy = staged(held.join(scale, name).withColumn("share", F.col("share") * F.col("scale")).drop("scale"), "raked")
            remove(spark, last)
            last = copy
    for copy in copies:
        remove(spark, copy)
    return held


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Fitted cells with ``probability``; expected tokens are ``budget`` of all."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    ratio = F.when(F.col("tokens") > 0, F.col("share") * total / F.col("tokens")).otherwise(1.0)
    rated = cells.withColumn("ratio", ratio)
    level = budget
    while True:
        # cells that are kept whole stay so: the level only rises
        whole = F.col("ratio") * level >= 1
        sums = rated.agg(
            F.sum(F.when(whole, F.col("tokens"))).alias("whole"),
            F.sum(F.when(~whole, F.col("tokens") * F.col("ratio"))).alias("rest"),
        ).first()
        rest = sums["rest"] or 0.0
        new = max(level, (budget * total - (sums["whole"] or 0)) / rest) if rest > 0 else level
        if new <= level * (1 + 1e-12):
            return rated.withColumn("probability", F.least(F.lit(1.0), F.col("ratio") * level))
        level = new


def _cells_of(docs: DataFrame, topic: Column | None) -> DataFrame:
    """``docs`` with ``__tokens`` and the cell as ``__source, __lang, __topic``."""
    counted = docs.withColumn("__tokens", token_count())
    named = topic if topic is not None else topic_of("text", "__tokens")
    values = {"__source": F.col("source"), "__lang": F.col("lang"), "__topic": named}
    return counted.withColumns({k: F.coalesce(v.cast("string"), F.lit(NONE)) for k, v in values.items()})


def _fitted(placed: DataFrame, targets: Mapping[str, DataFrame | float], budget: float, rounds: int) -> DataFrame:
    cells = placed.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens"))
    cells, copy = staged(cells, "cells")
    fitted = probabilities(raked(cells, targets, rounds), budget)
    remove(cells.sparkSession, copy)
    return fitted.select("source", "lang", "topic", "probability")


def sampling_plan(
    docs: DataFrame,
    targets: Mapping[str, DataFrame | float] = TEMPER,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    seed: str = SEED,
    topic: Column | None = None,
) -> DataFrame:
    """``doc_id, n_tokens, source, lang, topic, probability, kept``, one row per document."""
    placed = _cells_of(docs.select("doc_id", "text", "source", "lang"), topic).select(
        "doc_id",
        *[F.col(f"__{c}").alias(c) for c in ("source", "lang", "topic", "tokens")],
    )
    placed, _ = staged(placed, "placed")
    fitted = _fitted(placed, targets, budget, rounds)
    return placed.join(fitted, ["source", "lang", "topic"]).select(
        "doc_id",
        F.col("tokens").alias("n_tokens"),
        "source",
        "lang",
        "topic",
        "probability",
        (draw("doc_id", seed) < F.col("probability")).alias("kept"),
    )


def sampled_documents(
    docs: DataFrame,
    targets: Mapping[str, DataFrame | float] = TEMPER,
    budget: float = BUDGET,
    rounds: int = ROUNDS,
    seed: str = SEED,
) -> DataFrame:
    """The documents drawn, their columns as they are."""
    placed = _cells_of(docs, None)
    counts = placed.select(*[F.col(f"__{c}").alias(c) for c in ("source", "lang", "topic", "tokens")])
    fitted = _fitted(counts, targets, budget, rounds)
    fitted = fitted.select(*[F.col(c).alias(f"__of_{c}") for c in fitted.columns])
    same = [F.col(f"__{c}") == F.col(f"__of_{c}") for c in ("source", "lang", "topic")]
    drawn = placed.join(fitted, same).where(draw("doc_id", seed) < F.col("__of_probability"))
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])

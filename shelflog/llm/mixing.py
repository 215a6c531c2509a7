"""Temperature mixing of sources, realised as budgeted block permutations."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelflog.llm.common import column, fresh
from shelflog.session import materialize

BLOCK_TOKENS = 100_000
MAX_REPEAT = 2.0
SECTIONS = 32
PASSES = 5
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mix:
    """The exponent found and the share table: source, tokens, weight, repeats."""

    exponent: float
    budget: float
    sources: DataFrame


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def solve_exponent(
    sources: DataFrame, target_entropy: float | None, max_repeat: float | None, budget: float | None
) -> tuple[float, float]:
    """Exponent in [0, 1] and token budget for a table of sources with ``tokens``.

    Weights are share ** exponent, normalised; 1 keeps the shares, 0 makes them equal. The
    exponent is the largest whose entropy (nats) reaches ``target_entropy``, then raised until
    no source is read more than ``max_repeat`` times. Without a target it is the smallest
    that keeps the repetition limit. Each pass of the bisection cuts the interval into 32
    parts, all measured in one aggregate, so the driver sees sums and never the sources.
    """
    shared = sources.where("tokens > 0")
    total, least, most = shared.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
    if not total:
        return 1.0, 0.0
    log_least, log_most = math.log(least / total), math.log(most / total)
    log_share = F.log(F.col("tokens") / F.lit(float(total)))

    def measured(exponents: list[float]) -> list[tuple[float, float, float]]:
        sums = [F.sum(F.exp(log_share * a)) for a in exponents]
        logs = [F.sum(F.exp(log_share * a) * log_share * a) for a in exponents]
        row = shared.agg(*[s.alias(f"z{i}") for i, s in enumerate(sums)], *[s.alias(f"e{i}") for i, s in enumerate(logs)]).first()
        out = []
        for i, a in enumerate(exponents):
            z = row[f"z{i}"]
            entropy = math.log(z) - row[f"e{i}"] / z
            if budget is None:
                repeats = math.exp((log_least - log_most) * (a - 1))
            else:
                repeats = budget / total * math.exp(log_least * (a - 1)) / z
            out.append((a, entropy, repeats))
        return out

    def search(holds, largest: bool) -> float:
        """Edge of the exponents for which ``holds``: the largest or the smallest."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            grid = measured([low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)])
            good = [a for a, entropy, repeats in grid if holds(entropy, repeats)]
            if not good:
                return 0.0 if largest else 1.0
            edge, step = (max(good) if largest else min(good)), (high - low) / SECTIONS
            low, high = (edge, min(1.0, edge + step)) if largest else (max(0.0, edge - step), edge)
        return edge

    limited = 0.0 if max_repeat is None else search(lambda _, r: r <= max_repeat * (1 + 1e-9), largest=False)
    exponent = limited
    if target_entropy is not None:
        exponent = max(limited, search(lambda e, _: e >= target_entropy - 1e-9, largest=True))
    if budget is None:
        weights = shared.agg(F.sum(F.exp(log_share * exponent))).first()[0]
        budget = total * weights / math.exp(log_most * (exponent - 1))
    return exponent, budget


def plan_mix(
    docs: DataFrame,
    text_col: str,
    source_col: str,
    id_col: str,
    target_entropy: float | None,
    max_repeat: float | None,
    budget: float | None,
    block_tokens: int,
    seed: int,
) -> Mix:
    rows = materialize(
        docs.select(
            _source(source_col).alias("source"), column(id_col).alias("doc_id"), n_words(column(text_col)).alias("tokens")
        ),
        "mix-rows",
    )
    sources = materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    exponent, budget = solve_exponent(sources, target_entropy, max_repeat, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    z = sources.where("tokens > 0").agg(F.sum(F.pow(share, F.lit(exponent)))).first()[0] or 1.0
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(exponent)) / F.lit(z)).otherwise(0.0)
    planned = sources.withColumn("weight", weight).withColumn(
        "repeats",
        F.when(F.col("tokens") > 0, F.round(F.col("weight") * F.lit(float(budget)) / F.col("tokens"), 9)).otherwise(1.0),
    )
    planned = planned.select(
        "*",
        F.floor("repeats").alias("epochs"),
        F.floor((F.col("repeats") - F.floor("repeats")) * F.col("tokens")).alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / block_tokens)).alias("blocks"),
    )
    planned = materialize(planned, "mix-plan")

    # Tokens of each block, added up in the order of the last, partial epoch: first over
    # slices of the hash range, then inside the slice.
    placed = join_sources(rows, planned).where("rest > 0")
    placed = placed.withColumn("block", _block(F.col("doc_id"), F.col("blocks"), seed))
    per_block = materialize(
        placed.groupBy("source", "block", "rest", "epochs").agg(F.sum("tokens").alias("tokens")), "mix-blocks"
    )
    ordered = per_block.withColumn("turn", _turn(F.col("epochs"), F.col("block"), seed)).withColumn(
        "slice", F.shiftright("turn", 54)
    )
    slices = ordered.groupBy("source", "slice").agg(F.sum("tokens").alias("slice_tokens"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("base", F.coalesce(F.sum("slice_tokens").over(ahead), F.lit(0)))
    inside = Window.partitionBy("source", "slice").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, 0)
    summed = (
        ordered.join(slices.select(F.col("source").alias("s"), F.col("slice").alias("c"), "base"), (F.col("source") == F.col("s")) & (F.col("slice") == F.col("c")))
        .withColumn("end", F.col("base") + F.sum("tokens").over(inside))
        .withColumn("start", F.col("end") - F.col("tokens"))
    )
    cut = materialize(
        summed.where("start <= rest and end > rest")
        .groupBy("source")
        .agg(F.min(F.struct("turn", "block", (F.col("rest") - F.col("start")).alias("left"))).alias("cut"))
        .select("source", "cut.*"),
        "mix-cuts",
    )
    cut = cut.select(F.col("source").alias("cut_source"), F.col("turn").alias("cut_turn"), F.col("block").alias("cut_block"), "left")
    in_cut = placed.join(cut, (F.col("source") == F.col("cut_source")) & (F.col("block") == F.col("cut_block")))
    in_cut = in_cut.withColumn("place", _place(F.col("doc_id"), seed))
    upto = Window.partitionBy("source").orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    last = (
        in_cut.withColumn("used", F.sum("tokens").over(upto))
        .where("used <= left")
        .groupBy("source")
        .agg(F.max("place").alias("cut_place"))
        .select(F.col("source").alias("last_source"), "cut_place")
    )
    full = planned.join(cut, F.col("source") == F.col("cut_source"), "left").join(
        last, F.col("source") == F.col("last_source"), "left"
    )
    return Mix(exponent, budget, materialize(full.drop("cut_source", "last_source"), "mix"))


def _source(name: str) -> Column:
    # A null source is a source of its own.
    return F.coalesce(F.concat(F.lit("="), column(name).cast("string")), F.lit("null"))


def _block(doc_id: Column, blocks: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), blocks)


def _turn(epoch: Column, block: Column, seed: int) -> Column:
    """Place of a block in the permutation of an epoch, not negative."""
    return F.xxhash64(epoch.cast("long"), block.cast("long"), F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1))


def _place(doc_id: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id)


def join_sources(rows: DataFrame, planned: DataFrame) -> DataFrame:
    """Rows with the plan of their ``source``; sent to all tasks while it is small."""
    small = planned.count() <= BROADCAST_SOURCES
    side = planned.drop("tokens").withColumnRenamed("source", "plan_source")
    side = F.broadcast(side) if small else side
    return rows.join(side, F.col("source") == F.col("plan_source")).drop("plan_source")


def mix_sources(
    docs: DataFrame,
    name: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    target_entropy: float | None = None,
    max_repeat: float | None = MAX_REPEAT,
    budget: float | None = None,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = 7,
) -> DataFrame:
    """``docs`` with rows repeated or left out as the mix asks, and a struct column ``name``.

    Tokens are white-space separated words. Source weights are token shares raised to an
    exponent (``solve_exponent``) and normalised; a source is read weight * budget / tokens
    times. With ``budget`` None the budget is the least at which every source is read once
    in full, so no row is lost; a given budget (tokens) leaves rows out where a source gets
    less than one reading.

    A source is cut into blocks of about ``block_tokens`` by a hash of the doc_id. An epoch
    reads the blocks in an order of its own (``turn``); the last, partial epoch stops where
    its budget is spent, inside a block at a hash of the doc_id, and never exceeds it. The
    struct holds epoch, block, turn and the weight of the source. What the row pass needs
    is one row per source, so documents never shuffle, however large a source is.

    Cases: a null source is a source of its own; null and empty texts have no tokens, and a
    source without tokens is read once; rows that share a doc_id stay together in the
    partial epoch; a null doc_id is a value like any other. An empty table gives an empty
    result. All columns of ``docs`` stay as they are.
    """
    mix = plan_mix(docs, text_col, source_col, id_col, target_entropy, max_repeat, budget, block_tokens, seed)
    # The rows go into a struct, so that names of the plan never meet names of ``docs``.
    rows = docs.select(
        F.struct(*[column(c) for c in docs.columns]).alias("row"),
        _source(source_col).alias("source"),
        column(id_col).alias("doc_id"),
    )
    planned = mix.sources.select("source", "tokens", "weight", "epochs", "rest", "blocks", "cut_turn", "cut_block", "cut_place")
    wide = join_sources(rows, planned).withColumn("block", _block(F.col("doc_id"), F.col("blocks"), seed))
    last = _turn(F.col("epochs"), F.col("block"), seed)
    before = (last < F.col("cut_turn")) | ((last == F.col("cut_turn")) & (F.col("block") < F.col("cut_block")))
    inside = (F.col("block") == F.col("cut_block")) & (_place(F.col("doc_id"), seed) <= F.col("cut_place"))
    partial = F.when((F.col("rest") > 0) & F.coalesce(before | inside, F.lit(False)), 1).otherwise(0)
    copies = F.col("epochs") + partial
    epoch = F.explode(F.when(copies > 0, F.sequence(F.lit(0).cast("long"), copies - 1)).otherwise(F.array().cast("array<long>")))
    out = fresh(docs.columns, name)
    return wide.select("row", "block", "weight", epoch.alias("epoch")).select(
        "row.*",
        F.struct("epoch", "block", _turn(F.col("epoch"), F.col("block"), seed).alias("turn"), "weight").alias(out),
    )

"""Mixing sources to target weights: temperature on token shares, then block permutations.

A source with the share p of all tokens gets the weight p^a / sum of p^a. The exponent a lies
in 0 (all sources alike) to 1 (as they are) and is found by bisection: the largest that
reaches a target entropy, or the smallest that repeats no source more often than a limit.
One job evaluates a section of candidates at once from the table of sources, which stays
distributed; only one row per candidate comes to the driver.

With a budget of B tokens a source is read e = B * weight / tokens times. Its documents are
dealt into blocks of about `block_tokens` by hash, and every epoch reads each block in a
permutation of its own. The last, partial epoch reads a block's permutation until the block's
share of the budget is used. A hot source has more blocks, not larger ones. Built-in
functions only.

Nulls: a null text has no tokens, a null source is a source. A source without tokens costs
nothing and is read once. Repeated rows count as rows of their own. An empty table gives an
empty result. Columns of the input called `tokens`, `epoch`, `block` or `place` are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..params import cut_lineage

SECTIONS, ROUNDS = 32, 6


@dataclass(frozen=True)
class Mixture:
    """What the mix shall reach. Give `entropy` (share of the entropy of equal weights, 0 to 1)
    or `max_epochs` (no source is read more often). `budget` is in tokens; None is as many as
    there are; "all" is the least that reads every source once in full."""

    entropy: float | None = None
    max_epochs: float | None = None
    budget: float | str | None = None
    block_tokens: int = 200_000
    seed: int = 0


def words_of(text: Column) -> Column:
    """Words as runs of anything but ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def source_totals(rows: DataFrame, source: str = "source") -> DataFrame:
    """source, tokens, docs; summed before the shuffle, so a hot source is one row per task."""
    return rows.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("docs")
    )


def _section(totals: DataFrame, total: float, low: float, high: float) -> list:
    """Entropy, and the sums and extremes that fix the epochs, for exponents from low to high."""
    steps = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
    p = F.col("tokens") / F.lit(float(total))
    raised = F.pow(p, F.col("a"))
    return (
        totals.filter("tokens > 0")
        .select("tokens", F.explode(F.array(*[F.lit(s) for s in steps])).alias("a"))
        .groupBy("a")
        .agg(
            F.sum(raised).alias("z"),
            F.sum(raised * F.col("a") * F.log(p)).alias("zl"),
            F.max(raised / F.col("tokens")).alias("most"),
            F.min(raised / F.col("tokens")).alias("least"),
            F.count("*").alias("n"),
        )
        .withColumn("entropy", F.log("z") - F.col("zl") / F.col("z"))
        .withColumn("equal", F.log(F.col("n").cast("double")))
        .orderBy("a")
        .collect()
    )


def _budget(mix: Mixture, row, total: float) -> float:
    if mix.budget == "all":
        return row["z"] / row["least"]
    return float(total if mix.budget is None else mix.budget)


def find_exponent(totals: DataFrame, mix: Mixture) -> tuple[float, float, float]:
    """(exponent, sum of raised shares, budget). Falls back on 0 where the entropy is out of
    reach and on 1 where even that repeats too often; both are the nearest mixes there are."""
    if (mix.entropy is None) == (mix.max_epochs is None):
        raise ValueError("give either entropy or max_epochs")
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return 1.0, 1.0, 0.0

    def meets(row) -> bool:
        if mix.entropy is not None:
            return row["entropy"] >= mix.entropy * row["equal"] - 1e-12
        return _budget(mix, row, total) * row["most"] / row["z"] <= mix.max_epochs + 1e-12

    low, high, best = 0.0, 1.0, None
    for _ in range(ROUNDS):
        section = _section(totals, total, low, high)
        good = [i for i, row in enumerate(section) if meets(row)]
        if mix.entropy is not None:  # the least change: the largest exponent that is flat enough
            i = good[-1] if good else 0
            best = section[i]
            low, high = section[i]["a"], section[min(i + 1, SECTIONS)]["a"]
        else:  # the flattest mix within the limit
            i = good[0] if good else SECTIONS
            best = section[i]
            low, high = section[max(i - 1, 0)]["a"], section[i]["a"]
        if low == high:
            break
    return best["a"], best["z"], _budget(mix, best, total)


def source_plan(rows: DataFrame, mix: Mixture, source: str = "source") -> DataFrame:
    """source, tokens, docs, weight, epochs, blocks, as a stored table."""
    totals = cut_lineage(source_totals(rows, source), "source-totals")
    a, z, budget = find_exponent(totals, mix)
    total = F.lit(float(totals.agg(F.sum("tokens")).first()[0] or 1))
    weight = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / total, F.lit(a)) / F.lit(z)).otherwise(0.0)
    return totals.withColumn("weight", weight).select(
        "source", "tokens", "docs", "weight",
        F.when(F.col("tokens") > 0, F.lit(budget) * F.col("weight") / F.col("tokens")).otherwise(1.0).alias("epochs"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / mix.block_tokens)).cast("bigint").alias("blocks"),
    )


def mix_sources(docs: DataFrame, mix: Mixture, source: str = "source", text: str = "text") -> DataFrame:
    """One row per reading of a document: its columns, `tokens`, `epoch` (from 1), `block`
    (within the source) and `place` in the permutation of that block and epoch."""
    columns = [c for c in docs.columns if c not in ("tokens", "epoch", "block", "place")]
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    counted = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(f"`{source}`").alias("of"), words_of(F.col(f"`{text}`")).alias("tokens"),
        whole.alias("hash"),
    )
    plan = source_plan(counted.select(F.col("of").alias("source"), "tokens"), mix).select(
        F.col("source").alias("from"), "epochs", "blocks"
    )
    full = F.floor(F.col("epochs") + 1e-9)
    share = F.greatest(F.col("epochs") - full, F.lit(0.0))
    read = counted.join(plan, F.col("of").eqNullSafe(F.col("from"))).select(
        "row", "of", "tokens", "hash", full.alias("full"), share.alias("share"),
        F.pmod(F.col("hash"), F.col("blocks")).alias("block"),
        F.explode(
            F.filter(  # a source that is read less than once has epoch 1 in part
                F.sequence(F.lit(0), (full + F.when(share > 1e-9, 1).otherwise(0)).cast("int")),
                lambda e: e > 0,
            )
        ).alias("epoch"),
    )
    block = Window.partitionBy("of", "block", "epoch")
    order = block.orderBy(F.xxhash64(F.lit(mix.seed), F.col("epoch"), F.col("hash")), "hash")
    so_far = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))
    chosen = (
        read.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("so_far", so_far)
        .withColumn("in_block", F.sum("tokens").over(block))
        # half of the document that crosses the line decides, so blocks err to either side
        .filter(
            (F.col("epoch") <= F.col("full"))
            | (F.col("so_far") - F.col("tokens") / 2 <= F.col("share") * F.col("in_block"))
        )
    )
    return chosen.select(
        "row.*", "tokens", F.col("epoch").cast("int").alias("epoch"),
        F.col("block").cast("bigint").alias("block"), F.col("place").cast("bigint").alias("place"),
    )

"""Temperature mixing of sources, realised as budgeted block permutations.

Source shares of all tokens are raised to one exponent and normalised. The exponent is the
smallest (the flattest mix) that keeps every source within a repetition limit, or the largest
that reaches a target entropy. Both measures move one way with the exponent, so sections of
the bracket close in on it; each round is one aggregation over the table of sources.

Every source is hashed into a fixed number of blocks. Each pass over a source visits its blocks
in a permutation of its own, and the last pass stops where the source's budget ends. A
document needs only its source's line of the plan to know in which passes it takes part and at
which place, so nothing is sorted or gathered, however large a source is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareflow.llm.common import free_name, stored
from fareflow.llm.quality import words_of

BLOCKS = 1024  # per source; a power of two, so every odd step permutes them
SECTIONS = 64
ROUNDS = 6
EPOCHS = 1.0
MAX_REPEATS = 1.25


@dataclass(frozen=True)
class Target:
    """What the mix must meet: a repetition limit, or an entropy as a share of the highest."""

    epochs: float = EPOCHS
    max_repeats: float | None = MAX_REPEATS
    entropy: float | None = None


def block_tokens(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``source``, ``block``, ``tokens``; at most ``BLOCKS`` rows a source. No source is ''."""
    return docs.select(
        source_of().alias("source"), block_of(key).alias("block"), tokens_of().alias("tokens")
    ).groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))


def source_of() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def block_of(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col(key), F.col("text")), F.lit(BLOCKS)).cast("int")


def tokens_of() -> Column:
    return F.size(words_of(F.col("text"))).cast("long")


def _measures(shares: DataFrame, exponents: list[float], epochs: float) -> dict[float, tuple[float, float]]:
    """For every exponent the mix's entropy and the repeats of its most repeated source."""
    each = F.explode(F.array(*map(F.lit, exponents))).alias("x")
    powers = shares.select("p", each).withColumn("q", F.pow("p", "x"))
    rows = powers.groupBy("x").agg(
        F.sum("q").alias("z"), F.sum(F.col("q") * F.log("p")).alias("s"), F.min("p").alias("least")
    ).collect()
    return {
        r.x: (math.log(r.z) - r.x * r.s / r.z, epochs * r.least ** (r.x - 1) / r.z) for r in rows
    }


def find_exponent(shares: DataFrame, target: Target) -> float:
    """The exponent, between 0 and 1, for shares ``p``; 1, the shares as they are, if none will do."""
    sources = shares.count()
    if not sources:
        return 1.0

    def flat_enough(m: tuple[float, float]) -> bool:
        """Holds for small exponents, up to the one that is sought."""
        return m[0] >= target.entropy * math.log(sources) - 1e-12

    def even_too_flat(m: tuple[float, float]) -> bool:
        return m[1] > target.max_repeats + 1e-12

    below = flat_enough if target.entropy is not None else even_too_flat
    low, high = 0.0, 1.0
    ends = _measures(shares, [low, high], target.epochs)
    if not below(ends[low]):
        return low
    if below(ends[high]):
        return high
    for _ in range(ROUNDS):
        cuts = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        found = _measures(shares, sorted(set(cuts)), target.epochs)
        low = max(x for x in found if below(found[x]))
        high = min(x for x in found if x > low)
    return round(low if target.entropy is not None else high, 9)


def _place(source: Column, epoch: Column, block: Column) -> Column:
    """Where a pass visits a block: an odd step and a shift, drawn anew for each pass."""
    step = F.pmod(F.xxhash64(F.lit("step"), source, epoch), F.lit(BLOCKS // 2)) * 2 + 1
    shift = F.pmod(F.xxhash64(F.lit("shift"), source, epoch), F.lit(BLOCKS))
    return F.pmod(step * block + shift, F.lit(BLOCKS)).cast("int")


def plan(blocks: DataFrame, target: Target = Target()) -> DataFrame:
    """Per source its tokens, ``weight``, ``budget``, whole passes ``full`` and, for the pass after
    them, ``cutoff``: blocks whose place is below it take part.

    A block on the edge of the budget takes part if at least half of it fits, so a source
    misses its budget by half a block at most. Sources without tokens get nothing.
    """
    blocks = stored(blocks, "mix_blocks")
    sources = stored(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")).where("tokens > 0"), "mix_sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = sources.select((F.col("tokens") / F.lit(float(max(total, 1)))).alias("p"))
    exponent = find_exponent(shares, target)
    power = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(exponent))
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    passes = F.col("budget") / F.col("tokens")
    wanted = (
        sources.withColumn("weight", power / F.lit(norm))
        .withColumn("budget", F.round(F.col("weight") * F.lit(target.epochs * total), 3))
        .withColumn("full", F.floor(passes + 1e-12).cast("int"))
        .withColumn("rest", F.greatest(F.col("budget") - F.col("full") * F.col("tokens"), F.lit(0.0)))
    )
    placed = blocks.withColumnRenamed("tokens", "held").join(wanted, "source")
    placed = placed.withColumn("place", _place(F.col("source"), F.col("full"), F.col("block")))
    running = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("held").over(running), F.lit(0))
    placed = placed.withColumn("fits", (before + F.col("held") / 2) <= F.col("rest"))
    edge = F.coalesce(F.max(F.when(F.col("fits") & (F.col("held") > 0), F.col("place") + 1)), F.lit(0))
    keys = ["source", "tokens", "weight", "budget", "full"]
    return stored(placed.groupBy(*keys).agg(edge.cast("int").alias("cutoff")), "mix_plan")


def mix(docs: DataFrame, into: str, target: Target = Target(), key: str = "doc_id") -> DataFrame:
    """One row per document and pass, with a struct column ``into``.

    Its fields are ``n_tokens``, ``epoch``, ``block``, ``place`` (of the block in the pass) and
    ``position``, from 0 to below 1: the order of the mix, in which every source's blocks, pass after
    pass, are spread evenly. A column ``into`` must not be there yet.
    Null texts have no tokens, a null source counts as ''. Documents of a source without tokens
    are in no pass, nor are those outside their source's budget; repeated rows go together.
    """
    if into.lower() in [c.lower() for c in docs.columns]:
        raise ValueError(f"there is a column {into} already")
    rule = plan(block_tokens(docs, key), target)
    own = free_name(docs, "_mix")
    names = {n: f"{own}_{n}" for n in ("source", "block", "tokens", "budget", "full", "cutoff", "epoch")}
    at = {n: F.col(c) for n, c in names.items()}
    rule = rule.select(*[F.col(n).alias(names[n]) for n in ("source", "tokens", "budget", "full", "cutoff")])
    rows = docs.withColumn(names["block"], block_of(key)).join(rule, source_of() == at["source"])
    partly = _place(at["source"], at["full"], at["block"]) < at["cutoff"]
    passes = at["full"] + partly.cast("int")
    epochs = F.when(passes > 0, F.sequence(F.lit(0), passes - 1))
    rows = rows.withColumn(names["epoch"], F.explode(epochs))
    place = _place(at["source"], at["epoch"], at["block"])
    inside = F.pmod(F.xxhash64(F.lit("inside"), F.col(key), at["epoch"]), F.lit(1 << 20)) / float(1 << 20)
    done = (at["epoch"] * BLOCKS + place + inside) / (at["full"] * BLOCKS + at["cutoff"])
    described = F.struct(
        tokens_of().alias("n_tokens"), at["epoch"].alias("epoch"), at["block"].alias("block"),
        place.alias("place"), done.alias("position"),
    )
    return rows.withColumn(into, described).drop(*names.values())


def judge(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The mix of all documents: one row per document and pass, without texts."""
    return mix(docs.select(key, "source", "text"), "m", key=key).select(key, "source", "m.*")

"""Temperature mixing of sources, realised as budgeted block permutations.

With token shares ``p`` a source's weight is ``p**a / sum(p**a)``: a = 1 keeps
the shares, a = 0 makes them equal. The exponent is the largest in [0, 1]
whose weights reach ENTROPY of the greatest possible entropy; if some source
would then be repeated more than MAX_REPEATS times, it is raised until none
is (the limit wins). It is found by section search: every round evaluates
SECTIONS exponents in one aggregate over the sources and keeps one section.

The budget is split into whole tokens per source. A source is read in passes;
each pass is an own permutation of its documents (by a hash of seed, pass and
document), the last pass stops at the quota. A draw is placed by the source's
tokens before it, in proportion, into one of the blocks of BLOCK_TOKENS, so
every block holds the sources at their weights; inside a block the order is
another permutation. Running sums never gather a source: a pass is cut by
permutation value into buckets of about BUCKET_ROWS documents whose totals
are summed up first.

Tokens are runs of characters other than space and 0x09-0x0D. Documents
without tokens are never drawn. A null source is a source of its own.
Repeated rows are drawn one by one.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from casebook.llm.common import stage

ENTROPY = 0.95
MAX_REPEATS = 4.0
BLOCK_TOKENS = 1 << 18
BUCKET_ROWS = 4096
SECTIONS = 16
ROUNDS = 5
SEED = 42


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_tokens(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_docs"))


def find_exponent(sources: DataFrame, total: int, budget: int, entropy: float, max_repeats: float) -> float:
    """The exponent for ``sources`` (source, tokens > 0). Only sums over the sources reach the driver."""
    share = F.col("tokens") / F.lit(total)
    first = sources.agg(F.count(F.lit(1)).alias("n"), F.min(share).alias("least")).first()

    def evaluate(grid: list[float]) -> list[tuple[float, float]]:
        """(entropy / greatest entropy, repeats of the smallest source) of every exponent."""
        sums = [F.sum(F.pow(share, F.lit(a))) for a in grid] + [F.sum(F.pow(share, F.lit(a)) * F.log(share)) for a in grid]
        got = list(sources.agg(*sums).first())
        out = []
        for a, z, y in zip(grid, got[:len(grid)], got[len(grid):]):
            h = math.log(z) - a * y / z
            out.append((h / math.log(first["n"]) if first["n"] > 1 else 1.0,
                        first["least"] ** (a - 1) / z * budget / total))
        return out

    def largest(ok) -> float:
        """Largest exponent that satisfies ok, which holds below some point."""
        lo, hi = 0.0, 1.0
        if ok(evaluate([1.0])[0]):
            return 1.0
        for _ in range(ROUNDS):
            grid = [lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)]
            good = [a for a, v in zip(grid, evaluate(grid)) if ok(v)]
            lo = max(good, default=lo)
            hi = min([a for a in grid if a > lo], default=hi)
        return lo
    a = largest(lambda v: v[0] >= entropy)
    if evaluate([a])[0][1] <= max_repeats:
        return a
    step = 2.0 ** -20                      # section search ends on multiples of it: the next one keeps the limit
    return min(1.0, largest(lambda v: v[1] > max_repeats) + step)


def mix_sources(docs: DataFrame, budget: int | None = None, entropy: float = ENTROPY,
                max_repeats: float = MAX_REPEATS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per draw: doc_id, source, n_tokens, epoch, block, position (1.. inside the block).

    The training order is (block, position). ``budget`` defaults to the tokens of all documents.
    """
    rows = docs.select("doc_id", "source", token_count(F.col("text")).alias("n_tokens")).where("n_tokens > 0")
    rows = stage(rows, "mix_rows")
    sources = stage(source_tokens(rows), "mix_sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    if not total or budget < 1:
        return rows.limit(0).selectExpr("doc_id", "source", "n_tokens", "0L as epoch", "0L as block", "0 as position")
    a = find_exponent(sources, total, budget, entropy, max_repeats)
    power = F.pow(F.col("tokens") / F.lit(total), F.lit(a))
    norm = sources.agg(F.sum(power)).first()[0]
    plan = sources.withColumn("quota", F.floor(F.round(power / F.lit(norm), 9) * F.lit(budget)).cast("long"))
    plan = plan.withColumn("passes", F.expr("quota div tokens")).withColumn("rest", F.expr("quota % tokens"))
    plan = stage(plan.where("quota > 0").withColumnRenamed("source", "s"), "mix_plan")

    drawn = rows.join(plan, rows.source.eqNullSafe(plan.s)).drop("s")
    drawn = drawn.withColumn("epoch", F.explode(F.expr("sequence(0L, if(rest > 0, passes, passes - 1))")))
    drawn = drawn.withColumn("perm", F.xxhash64(F.lit(SEED), "epoch", "doc_id", "n_tokens"))
    drawn = drawn.withColumn("bucket", F.floor((F.col("perm") / F.lit(2.0 ** 64) + 0.5) * F.ceil(F.col("n_docs") / BUCKET_ROWS)))
    key = ["source", "epoch", "bucket"]
    sums = drawn.groupBy(*key).agg(F.sum("n_tokens").alias("t"))
    earlier = Window.partitionBy("source", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*(F.col(k).alias(f"k_{k}") for k in key), F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy(*key).orderBy("perm", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    drawn = drawn.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    drawn = drawn.join(sums, F.col("source").eqNullSafe(F.col("k_source")) & (F.col("epoch") == F.col("k_epoch")) & (F.col("bucket") == F.col("k_bucket")))
    start = F.col("before") + F.col("within")
    drawn = drawn.withColumn("start", start).where((F.col("epoch") < F.col("passes")) | (F.col("start") < F.col("rest")))

    blocks = -(-budget // block_tokens)
    place = (F.col("epoch") * F.col("tokens") + F.col("start")) / F.col("quota") * F.lit(blocks)
    drawn = drawn.withColumn("block", F.least(F.floor(place), F.lit(blocks - 1)).cast("long"))
    order = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(SEED), "block", "epoch", "doc_id", "n_tokens"), "doc_id", "epoch", "n_tokens", "source")
    return drawn.select("doc_id", "source", "n_tokens", "epoch", "block", F.row_number().over(order).alias("position"))

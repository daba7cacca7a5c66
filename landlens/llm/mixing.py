"""Mix sources to target weights by fitting a word budget exactly.

Every source has a weight; the targets share the whole corpus size by weight, none above ``max_repeats`` times its
source's size, the excess going to the others by weight until none is above. A source's target
is met in whole documents:

1. documents are counted by exact size, per source;
2. the target is spread over the sizes in proportion to their counts, in whole copies of documents, at most ``max_repeats`` of each;
3. what then remains of the budget is fitted by a bounded-knapsack (subset-sum) dynamic programme over the copies still free of each size;
4. all documents of a size get the same number of copies, and some one more; which ones is
   decided by a seeded hash. Hash ranges are counted first, so that only the range in which the
   cut falls is ordered: a size that holds a third of all rows is never sorted in one task.

Defined results: a null text has size 0; documents of size 0 are taken 0 words and
never move a target; null sources form one source, last in order; a source of size 0 has target 0. Repeated rows
count each; equal rows are interchangeable. An empty table gives an empty result. The same rows and seed give the
same plan however they are partitioned.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import NON_SPACES, pin, shuffle_partitions, text_or_empty

#: Hash ranges of a (source, size) group.
RANGES = 1024


def words_in(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(NON_SPACES)).cast("bigint")


def targets(sizes: dict, weights: list[float], budget: float, max_repeats: float = 3) -> dict:
    """Water filling over the sources, ordered by code point with None last; weights repeat along that order."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    open_, out, left = list(order), {}, float(budget)
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > max_repeats * sizes[s]]
        if not full:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in full:
            out[s] = float(max_repeats * sizes[s])
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    return out


def _subset_sum(items: list[tuple[int, int]], budget: int) -> dict[int, int]:
    """Bounded knapsack: counts by size whose sum comes nearest to ``budget``.
    Sets of reachable sums are the bits of one integer; a size of count n is taken in 1, 2, 4, ... copies."""
    top = budget + max((s for s, _ in items), default=0)
    mask, layers, reach = (1 << (top + 1)) - 1, [], 1
    for size, count in items:
        part = 1
        while count > 0 and size * part <= top:
            k = min(part, count)
            layers.append((size, k, reach))
            reach |= (reach << (size * k)) & mask
            count -= k
            part *= 2
        if reach >> budget & 1:
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> budget
    above = budget + (above & -above).bit_length() - 1 if above else None
    at = below if above is None or budget - below <= above - budget else above
    taken = {}
    for size, k, before in reversed(layers):
        if not before >> at & 1:
            taken[size] = taken.get(size, 0) + k
            at -= size * k
    return taken


def plan_counts(sizes: list[int], counts: list[int], budget: int, most: int = 1) -> list[int]:
    """How many copies of documents of each size to take, at most ``most`` of each document, so that their sizes come nearest to ``budget``."""
    total = sum(s * c for s, c in zip(sizes, counts))
    budget = min(budget, most * total)
    if total == 0 or budget <= 0:
        return [0] * len(sizes)
    take = [c * budget // total for c in counts]
    left = budget - sum(s * t for s, t in zip(sizes, take))
    # One more of the sizes whose fair share was cut off most, while the rest of the budget is well above one document.
    small = max(4 * max(sizes), 65536)
    for i in sorted(range(len(sizes)), key=lambda i: (-((counts[i] * budget) % total), sizes[i])):
        if 0 < sizes[i] <= left - small and take[i] < most * counts[i]:
            take[i] += 1
            left -= sizes[i]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):  # in case shares were even
        more = min(most * counts[i] - take[i], max(0, left - small) // sizes[i]) if sizes[i] else 0
        take[i] += more
        left -= more * sizes[i]
    free = [(s, most * c - t) for s, c, t in zip(sizes, counts, take) if s and most * c > t]
    extra = _subset_sum(sorted(free), left)
    return [t + extra.get(s, 0) for s, t in zip(sizes, take)]


def _plan_source(most: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("size")
        sizes, counts = [int(x) for x in group["size"]], [int(x) for x in group["n"]]
        take = plan_counts(sizes, counts, int(round(float(group["target"].iloc[0]))), most)
        # All documents of a size get the same number of copies, some one more.
        return group.assign(whole=[t // c for t, c in zip(take, counts)], extra=[t % c for t, c in zip(take, counts)])
    return run


def mix(docs: DataFrame, weights: list[float], budget_share: float = 1.0, max_repeats: int = 3, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry_row: bool = False) -> DataFrame:
    """One row per document: id, size, source_size, target, repeats, taken; with ``carry_row`` also the input row."""
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).cast("string").alias("source"), words_in(F.col(text_col)).alias("size"),
                       F.xxhash64(F.lit(seed), F.col(id_col), text).alias("__h"), *([F.struct("*").alias("__row")] if carry_row else []))
    if not carry_row:
        rows = pin(rows)
    lean = rows.drop("__row") if not carry_row else pin(rows.select("source", "size", "__h"))
    histogram = pin(lean.groupBy("source", "size").agg(F.count("*").alias("n")))
    sources = {r["source"]: int(r["s"]) for r in histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("s")).collect()}
    goal = targets(sources, weights, budget_share * sum(sources.values()), max_repeats)
    goals = docs.sparkSession.createDataFrame([(s, goal[s], sources[s]) for s in sources], "source string, target double, source_size bigint")
    plan = (histogram.join(F.broadcast(goals), histogram["source"].eqNullSafe(goals["source"]))
            .select(histogram["source"], "size", "n", "target", "source_size")
            .groupBy("source").applyInPandas(_plan_source(max_repeats), "source string, size bigint, n bigint, target double, source_size bigint, whole bigint, extra bigint"))
    named = lambda df: df.withColumn("__s", F.coalesce("source", F.lit(""))).withColumn("__null", F.col("source").isNull()).drop("source").withColumn("__range", F.pmod("__h", F.lit(RANGES)))
    plan = pin(named(plan.withColumn("__h", F.lit(0))).drop("__h", "__range"))
    keys = ["__s", "__null", "size"]

    # Ranges of a group in order: those before the cut are taken whole, the one at the cut in part, the others not.
    counted = pin(named(lean).groupBy(*keys, "__range").agg(F.count("*").alias("__n")))
    upto = F.sum("__n").over(Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cuts = (counted.join(plan.where("extra > 0 and extra < n").select(*keys, "extra"), keys).withColumn("__upto", upto).where("__upto >= extra and __upto - __n < extra")
            .select(*keys, F.col("__range").alias("cut"), (F.col("extra") - F.col("__upto") + F.col("__n")).alias("room")))
    plan = pin(plan.join(cuts, keys, "left"))
    placed = named(rows).join(plan, keys).withColumn("__extra", F.when(F.col("extra") <= 0, F.lit(0)).when(F.col("extra") >= F.col("n"), F.lit(1))
                                                     .when(F.col("__range") < F.col("cut"), F.lit(1)).when(F.col("__range") > F.col("cut"), F.lit(0)).cast("bigint"))
    order = F.row_number().over(Window.partitionBy(*keys, "__range").orderBy("__h", "__id"))
    clear = placed.where(F.col("__extra").isNotNull())
    partly = (placed.where(F.col("__extra").isNull()).repartition(shuffle_partitions(docs.sparkSession), *keys, "__range")
              .withColumn("__extra", (order <= F.col("room")).cast("bigint")))
    repeats = F.col("whole") + F.col("__extra")
    out = [F.col("__id").alias(id_col), "size", "source_size", "target", repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"), *(["__row"] if carry_row else [])]
    return clear.select(*out).unionByName(partly.select(*out))


def mixed_documents(docs: DataFrame, weights: list[float], **options) -> DataFrame:
    """The mix itself: each input row as often as it is taken."""
    mixed = mix(docs, weights, carry_row=True, **options).where("repeats > 0")
    return mixed.select(F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("__copy"), "__row").select("__row.*")

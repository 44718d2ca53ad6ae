"""Mixing of sources to target weights by min-cost flow.

Documents are aggregated by the set of sources they belong to (their
membership pattern). A flow from patterns to sources then decides how many
words of each pattern count for each source: a pattern supplies its words once
at cost 1, a second time at cost 2 and so on up to ``max_repeats`` (convex
repetition costs), and a source takes at most its quota. Only the supplies
cost, so the least cost for the largest flow is found by sending as much as
possible from the cheapest round of supplies first, rerouting where needed.
The flow sees one row per pattern, never documents.

Within a pattern, documents are taken whole in the order of a seeded hash of
their id and text, up to the pattern's share. The last hash taken is found
from sums over 2 ** 14 ranges of the hash and a running sum inside the one
range that holds it, so no task orders a whole source.

Cases: null text is empty (size 0, never taken); a null source is a source of
its own, after all others; repeated rows have equal hashes and are taken or
left together. A table without words yields targets of 0. Columns of
the input named like internal ones are not touched (the rows travel in a
struct).
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendflow.llm.common import SPACES, materialize, read_table

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_REPEATS = 2
SEED = 8
RANGE_BITS = 14


def word_count(text: Column) -> Column:
    """Number of words, as pieces between the spaces of the trimmed text."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACES}|{SPACES}$", "")
    return F.when(t == "", 0).otherwise(F.size(F.split(t, SPACES, -1))).cast("long")


def targets(sizes: dict[str | None, int], weights: tuple = WEIGHTS, budget: float = BUDGET,
            cap: float = MAX_REPEATS) -> dict[str | None, float]:
    """Words wanted of each source: ``budget`` times all words by weight, none
    above ``cap`` times its own, the excess shared by weight among the rest."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = budget * sum(sizes.values())
    full: set = set()
    while True:
        rest = total - sum(cap * sizes[s] for s in order if s in full)
        base = sum(weight[s] for s in order if s not in full)
        share = {s: rest * weight[s] / base for s in order if s not in full} if base else {}
        over = {s for s, x in share.items() if x > cap * sizes[s]}
        if not over:
            return {s: share.get(s, float(cap * sizes[s])) for s in order}
        full |= over


def route(supply: dict[tuple, float], quota: dict, max_repeats: int = MAX_REPEATS) -> dict[tuple, dict]:
    """Flow {pattern: {source: words}} of largest value and least cost."""
    flow = {p: dict.fromkeys(p, 0.0) for p in supply}
    left = dict(quota)
    holders: dict = {}
    for p in supply:
        for s in p:
            holders.setdefault(s, []).append(p)
    eps = 1e-9 * max(1.0, sum(quota.values()))
    for _ in range(max_repeats):  # one unit of marginal cost more in each round
        room = dict(supply)
        for start in supply:
            while room[start] > eps:
                path = _path(start, flow, left, holders, eps)
                if path is None:
                    break
                # path: pattern, source, pattern, ..., source; each later pattern gives up flow to the source before it
                amount = min(room[start], left[path[-1]],
                             *[flow[path[i + 1]][path[i]] for i in range(1, len(path) - 1, 2)])
                for i in range(0, len(path) - 1, 2):
                    flow[path[i]][path[i + 1]] += amount
                    if i + 2 < len(path):
                        flow[path[i + 2]][path[i + 1]] -= amount
                left[path[-1]] -= amount
                room[start] -= amount
    return flow


def _path(start, flow, left, holders, eps):
    """Shortest way from a pattern to a source with room, over reroutable flow."""
    came: dict = {("p", start): None}
    queue = deque([("p", start)])
    while queue:
        kind, at = here = queue.popleft()
        if kind == "s" and left[at] > eps:
            path = []
            while here is not None:
                path.append(here[1])
                here = came[here]
            return path[::-1]
        steps = [("s", s) for s in at] if kind == "p" else [("p", p) for p in holders[at] if flow[p][at] > eps]
        for step in steps:
            if step not in came:
                came[step] = here
                queue.append(step)
    return None


def _keyed(docs: DataFrame, members: Column | None, text: str, key: str, seed: int, *more: Column) -> DataFrame:
    members = F.array(F.col("source")) if members is None else members
    return docs.select(
        F.col(key).alias("key"), F.array_sort(F.array_distinct(members)).alias("pattern"),
        F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key), F.xxhash64(text)), 1).alias("u"), *more)


def plan(sized: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per pattern of ``sized`` (key, pattern, u, size; materialised):
    source_size, target, passes (times every document is taken) and last_u
    (documents up to this hash are taken once more)."""
    spark = sized.sparkSession
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("size")).collect()  # one row per pattern
    supply = {tuple(r["pattern"]): int(r["size"]) for r in sums}
    source_size: dict = {}
    for p, n in supply.items():
        for s in p:
            source_size[s] = source_size.get(s, 0) + n
    target = targets(source_size, weights, budget, max_repeats)
    flow = route({p: float(n) for p, n in supply.items()}, target, max_repeats)
    rows = []
    for p, n in supply.items():
        total = sum(flow[p].values())
        passes = min(max_repeats, int(total / n + 1e-9)) if n else 0
        rows.append((list(p), sum(source_size[s] for s in p), float(sum(target[s] for s in p)), passes,
                     max(0.0, total - passes * n)))
    shares = spark.createDataFrame(rows, "pattern array<string>, source_size long, target double, passes long, more double")
    # running sums over the ranges of each pattern (2 ** RANGE_BITS rows of one at most)
    slot = F.shiftright("u", 63 - RANGE_BITS).cast("int")
    ranges = sized.groupBy("pattern", slot.alias("slot")).agg(F.sum("size").alias("words"))
    below = F.sum("words").over(Window.partitionBy("pattern").orderBy("slot")) - F.col("words")
    cuts = (ranges.withColumn("below", below)
            .join(shares.select("pattern", "more"), "pattern")
            .where((F.col("below") < F.col("more")) & (F.col("below") + F.col("words") >= F.col("more")))
            .select("pattern", F.col("slot").alias("cut"), "below", "more"))
    inside = (sized.withColumn("slot", slot).join(cuts, "pattern")
              .where(F.col("slot") == F.col("cut")))
    running = F.sum("size").over(Window.partitionBy("pattern").orderBy("u", "key", "size")
                                 .rowsBetween(Window.unboundedPreceding, 0))
    least = F.shiftleft(F.col("cut").cast("long"), 63 - RANGE_BITS) - 1  # where not even the range's first is taken
    last = (inside.withColumn("fits", F.col("below") + running - F.col("size") / 2 <= F.col("more"))
            .groupBy("pattern").agg(F.coalesce(F.max(F.when(F.col("fits"), F.col("u"))), F.max(least)).alias("last_u")))
    # a row per pattern: Spark broadcasts it, and what is joined here, where its size allows
    return materialize(shares.drop("more").join(last, "pattern", "left"), "shares")


def _sized(docs: DataFrame, members, text, key, seed) -> DataFrame:
    return materialize(_keyed(docs, members, text, key, seed, word_count(F.col(text)).alias("size")), "sizes")


def _times(max_repeats: int) -> Column:
    again = F.coalesce(F.col("u") <= F.col("last_u"), F.lit(False)).cast("long")
    return F.least(F.lit(max_repeats).cast("long"), F.col("passes") + again)


def mix(docs: DataFrame, members: Column | None = None, text: str = "text", key: str = "doc_id",
        weights: tuple = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """(key, size, source_size, target, taken) per row of ``docs``.

    ``members``: array of the sources a document belongs to (default: its
    ``source``); source_size and target are sums over them.
    """
    sized = _sized(docs, members, text, key, seed)
    shares = plan(sized, weights, budget, max_repeats)
    return (sized.join(shares, "pattern")
            .select(F.col("key").alias(key), "size", "source_size", "target",
                    (F.col("size") * _times(max_repeats)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, members: Column | None = None, text: str = "text", key: str = "doc_id",
                    weights: tuple = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS,
                    seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept.
    Documents without words are left out, as the mix takes nothing of them."""
    shares = plan(_sized(docs, members, text, key, seed), weights, budget, max_repeats)
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = _keyed(docs.where(worded), members, text, key, seed, F.struct("*").alias("row"))
    times = _times(max_repeats).cast("int")
    return (rows.join(shares, "pattern").where(times > 0)
            .withColumn("row", F.explode(F.array_repeat("row", times))).select("row.*"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs)

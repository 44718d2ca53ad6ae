"""From bucketed classes to exact links and connected components.

A *class* is a set of rows that are copies of each other; a *node* (16 bytes,
a digest of the content) names it. Buckets propose which nodes to compare.
No pair of a bucket is ever emitted: buckets become star edges (one row per
member), the stars' components become clusters, and the nodes of a cluster are
dealt over blocks of bounded size. A task compares two blocks of a cluster in
memory and returns one row per node: its number of links there and the
smallest node it is joined to. Every pair of a cluster meets in exactly one
task, so counts add up without duplicates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendflow.llm.common import discard, materialize

#: Nodes of one block; a task holds two blocks at a time.
BLOCK = 256
#: Tasks over which the rows of one key are dealt (bits of a long).
SALTS = 32
#: compare(payloads, left, right) -> boolean matrix len(left) x len(right).
Compare = Callable[[list, np.ndarray, np.ndarray], np.ndarray]


def salt(by: str | Column) -> Column:
    return F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")


def salted_totals(rows: DataFrame, key: str, partial: list[Column], final: list[Column]) -> DataFrame:
    """One row per key of ``rows`` (which have ``_salt``): ``final`` aggregates of
    the ``partial`` ones per key and salt, and ``_salts``, the salts as bits."""
    bit = F.expr("shiftleft(1L, _salt)")
    return rows.groupBy(key, "_salt").agg(*partial).groupBy(key).agg(*final, F.bit_or(bit).alias("_salts"))


def by_salt(totals: DataFrame) -> DataFrame:
    """A row per salt of a key, to be joined by key and salt: a key that a third
    of all rows have meets its totals in ``SALTS`` tasks."""
    held = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("_salts", i) == 1)
    return totals.withColumn("_salt", F.explode(held)).drop("_salts")


def with_totals(rows: DataFrame, key: str, by: str, partial: list[Column], final: list[Column],
                where: Column | None = None) -> DataFrame:
    """``rows`` with aggregates of their key, without the rows of keys that
    ``where`` leaves out."""
    dealt = rows.withColumn("_salt", salt(by))
    totals = salted_totals(dealt, key, partial, final)
    totals = totals if where is None else totals.where(where)
    return dealt.join(by_salt(totals), [key, "_salt"]).drop("_salt")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges``.

    ``edges`` has columns ``a`` and ``b`` of one orderable type. Alternating
    large-star and small-star rounds (logarithmically many); each is
    aggregates and equi-joins over edges and is written to shared scratch.
    Self-loops and nulls are ignored; a node without edges is not returned.
    ``held`` of the result lists the scratch tables that it reads.
    """
    cur = materialize(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a") != F.col("b")).distinct(), "edges")
    state = _fingerprint(cur)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        last, cur = cur, materialize(_small_star(_large_star(cur)), "edges")
        before, state = state, _fingerprint(cur)
        discard(last)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    out = cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
    out.held = [cur]
    return out


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the centre of a star has as many edges as its component has nodes
    rows = with_totals(both, "a", "b", [F.min("b").alias("m")], [F.min("m").alias("m")])
    return (rows.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # a > b holds on every row that the large star makes
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def short(node: str = "node") -> Column:
    """The first seven bytes of a node as a number. Nodes that agree in them
    share a cluster, which only means that they are compared."""
    return F.conv(F.hex(F.substring(node, 1, 7)), 16, 10).cast("long")


def candidate_clusters(buckets: DataFrame) -> DataFrame:
    """(id, cluster) for the ids that share a bucket with another one.

    ``buckets``: (id, bucket) of ``short`` ids, materialised, as it is read
    twice; nothing reads it any more once this returns. ``held`` as above.
    """
    star = with_totals(buckets, "bucket", "id", [F.min("id").alias("b"), F.max("id").alias("top")],
                       [F.min("b").alias("b"), F.max("top").alias("top")], F.col("b") != F.col("top"))
    star = star.select(F.col("id").alias("a"), "b")
    comp = connected_components(star)
    out = comp.select(F.col("node").alias("id"), F.col("root").alias("cluster"))
    out.held = comp.held
    return out


def blocked(clusters: DataFrame, payload: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (cluster, lo, hi, blk, node, weight, payload): the tasks' inputs."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = (with_totals(clusters, "cluster", "id", [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")])
             .select("id", "cluster", blocks.alias("blocks"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("blk")))
    return (payload.withColumn("id", short()).join(dealt, "id")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("cluster", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi"),
                    "blk", "node", "weight", "payload"))


def links(clusters: DataFrame, payload: DataFrame, compare: Compare, block: int = BLOCK) -> DataFrame:
    """(node, n, root): weights linked directly, smallest node reachable.

    ``payload``: (node, weight, payload), one row per node (further rows of a
    node are ignored). Nodes without a link are returned with n = 0. Nothing
    reads ``clusters`` any more once this returns. ``held`` as above.
    """
    rows = blocked(clusters, payload, block)
    kind = dict(rows.dtypes)["payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _groups(batches, kind == "binary"):
            yield from _compare_cell(cells, compare)

    found = materialize(
        rows.repartition("cluster", "lo", "hi").sortWithinPartitions("cluster", "lo", "hi", "node")
        .mapInArrow(run, "node binary, n long, root binary"), "links")
    per_node = found.groupBy("node").agg(F.sum("n").alias("n"))
    comp = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    out = (per_node.join(comp, "node", "left")
           .select("node", "n", F.coalesce("root", "node").alias("root")))
    out.held = [found, *comp.held]
    return out


def _groups(batches: Iterator[pa.RecordBatch], binary: bool) -> Iterator[tuple]:
    """The rows of one (cluster, lo, hi) at a time, across batch borders."""
    key, nodes, blks, weights, loads = None, [], [], [], []
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        keys = list(zip(cols["cluster"].to_pylist(), cols["lo"].to_pylist(), cols["hi"].to_pylist(), strict=True))
        node, blk, weight = (cols[c].to_pylist() for c in ("node", "blk", "weight"))
        load = cols["payload"]
        for i, k in enumerate(keys):
            if k != key:
                if len(nodes) > 1:
                    yield key, nodes, blks, weights, loads
                key, nodes, blks, weights, loads = k, [], [], [], []
            if nodes and nodes[-1] == node[i]:
                continue
            nodes.append(node[i])
            blks.append(blk[i])
            weights.append(weight[i])
            loads.append(load[i].as_py() if binary else load[i].values.to_numpy(zero_copy_only=False))
    if len(nodes) > 1:
        yield key, nodes, blks, weights, loads


def _compare_cell(cell: tuple, compare: Compare) -> Iterator[pa.RecordBatch]:
    (_, lo, hi), nodes, blks, weights, loads = cell
    blks, weights = np.array(blks), np.array(weights, dtype=np.int64)
    left = np.flatnonzero(blks == lo)
    right = left if lo == hi else np.flatnonzero(blks == hi)
    if not len(left) or not len(right):
        return
    hit = compare(loads, left, right)
    if lo == hi:
        hit = hit & ~np.eye(len(left), dtype=bool)
    count = np.zeros(len(nodes), dtype=np.int64)
    count[left] += hit.astype(np.int64) @ weights[right]
    if lo != hi:
        count[right] += hit.T.astype(np.int64) @ weights[left]
    root = _roots(len(nodes), left, right, hit)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(count), pa.array([nodes[r] for r in root], pa.binary())],
        names=["node", "n", "root"])


def _roots(n: int, left: np.ndarray, right: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Smallest index joined to each index (nodes come in ascending order)."""
    root = np.arange(n)
    a, b = np.nonzero(hit)
    a, b = left[a], right[b]
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root

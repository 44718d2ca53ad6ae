"""Near duplicates among embeddings by cross-polytope hashing.

A vector of unit length is turned by three rounds of random signs and a fast
Hadamard transform; its hash is the coordinate of largest magnitude with its
sign, i.e. the nearest vertex of the cross-polytope. A table concatenates
``rotations`` hashes. Multiprobe: besides its own bucket, a vector also enters
the buckets in which one hash is replaced by the second-nearest vertex.

Pairs are compared within buckets, by cosine in double precision, and a pair
counts only in the first bucket that it shares. A bucket of more than ``BLOCK``
vectors is dealt over blocks, two of which meet in a task. So that buckets hold
few vectors that only chance brought there, ``rotations`` follows the number n
of vectors of the largest label: the least K >= 3 with

    tables * (1 + K)**2 * n / (2 * width)**K <= 1,    tables = 4 * K

(width: dimensions, up to a power of two), i.e. at most one such partner per
vector in all tables. A table misses a pair of cosine 0.98 with a probability
of 0.13 at K = 3, 0.20 at 4, 0.29 at 5, 0.37 at 6 and 0.53 at 8 (simulated, 64
dimensions), all tables with 1e-11 to 2e-9.

Cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are their own component, as are vectors whose
label is null. Only vectors of equal label and equal length are compared.
Components of any magnitude count: a vector is divided by its largest one
before its norm is taken. Repeated rows are copies of each other and count as
links of one another. A null id keeps its row; its component is the smallest id
that is not null. Other input columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import discard, materialize, read_table
from trendflow.llm.linking import by_salt, connected_components, salt, salted_totals, with_totals

THRESHOLD = 0.98
SEED = 20
#: Vectors of a bucket that are compared at a time with as many others.
BLOCK = 512
#: Cells of at most so many vectors are compared together.
SMALL = 24
PAIRS = 1 << 14
#: Tasks over which the rows of one bucket are counted.
SALTS = 64


def rotations_for(n: int, width: int) -> int:
    """Hashes of a table for n vectors of ``width`` coordinates (see above)."""
    k = 3
    while 4 * k * (1 + k)**2 * n > (2 * width)**k:
        k += 1
    return k


def width_of(d: int) -> int:
    return 1 << max(1, (d - 1).bit_length())


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of norm 1 in double precision, whatever their magnitude."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two of columns)."""
    n, d = x.shape
    step = 1
    while step < d:
        pairs = x.reshape(n, -1, 2, step)
        x = np.concatenate([pairs[:, :, :1] + pairs[:, :, 1:], pairs[:, :, :1] - pairs[:, :, 1:]], axis=2).reshape(n, d)
        step *= 2
    return x


def probes(x: np.ndarray, rotations: int, seed: int = SEED) -> np.ndarray:
    """Bucket numbers of unit rows: shape (rows, tables * (1 + rotations))."""
    n, d = x.shape
    width = width_of(d)
    padded = np.zeros((n, width))
    padded[:, :d] = x
    rng = np.random.default_rng([seed, d])
    out = []
    for table in range(4 * rotations):
        best, second = [], []
        for _ in range(rotations):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * rng.choice([-1.0, 1.0], size=width)) / np.sqrt(width)
            two = np.argpartition(-np.abs(turned), 1, axis=1)[:, :2]
            value = np.take_along_axis(turned, two, axis=1)
            order = np.argsort(-np.abs(value), axis=1, kind="stable")
            two, value = np.take_along_axis(two, order, axis=1), np.take_along_axis(value, order, axis=1)
            vertex = (2 * two + (value < 0)).astype(np.uint64)
            best.append(vertex[:, 0])
            second.append(vertex[:, 1])
        for flip in range(-1, rotations):
            code = np.full(n, table + 1, dtype=np.uint64)
            for k in range(rotations):  # a hash of the table and its vertices, which may not fit in 64 bits
                code = (code ^ (code >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (second[k] if k == flip else best[k])
            out.append(code.view(np.int64))
    return np.stack(out, axis=1)


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    length = np.diff(column.offsets.to_numpy())
    starts = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
    return column.flatten().to_numpy(zero_copy_only=False), starts, length


def _hash_batches(n: int, seed: int):
    """Adds the buckets of each vector: hashes of its space and its codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts, length = _vectors(batch.column("payload"))
            space = batch.column("space_hash").to_numpy()
            buckets: list = [None] * len(length)
            for d in np.unique(length):
                rows = np.flatnonzero(length == d)
                found = probes(unit(flat[starts[rows][:, None] + np.arange(d)]), rotations_for(n, width_of(int(d))), seed)
                found = (found ^ space[rows][:, None]) * np.int64(-7046029254386353131)
                for i, r in enumerate(rows):
                    buckets[r] = found[i]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("node", "weight", "payload", "space")] + [pa.array(buckets, pa.list_(pa.int64()))],
                names=["node", "weight", "payload", "space", "buckets"])

    return run


def _shared_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition sorted by bucket whose bucket a neighbour has, and
    its first and last row, whose neighbours may lie in other partitions."""
    held, same = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column("bucket").to_numpy()
        equal = key[1:] == key[:-1]
        keep = np.concatenate([[same], equal[:-1]]) | equal if len(key) > 1 else np.zeros(0, dtype=bool)
        yield batch.slice(0, len(keep)).filter(pa.array(keep))
        held, same = batch.slice(len(keep)), bool(equal[-1]) if len(key) > 1 else same
    if held is not None:
        yield held


def _in_first_bucket(a: np.ndarray, b: np.ndarray, bucket: np.ndarray, rotations: int) -> np.ndarray:
    """Whether a pair's ``bucket`` is the first that it shares: of the first
    table in which any of its probes meet, the least number."""
    a, b = (x.reshape(len(x), -1, 1 + rotations) for x in (a, b))
    met = (a[:, :, :, None] == b[:, :, None, :]).any(axis=3)
    table = met.any(axis=2).argmax(axis=1)
    at = np.arange(len(a))
    first = np.where(met[at, table], a[at, table], np.iinfo(np.int64).max).min(axis=1)
    return first == bucket


def _compare(threshold: float):
    """(node, n, root) per vector of some cells: weight linked there, and the
    smallest node that it is joined to. Every linked pair counts once."""

    def solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        flat, starts, length = _vectors(rows.column("payload").combine_chunks())
        codes, code_at, code_n = _vectors(rows.column("buckets").combine_chunks())
        node, space = rows.column("node").to_pylist(), rows.column("space").to_pylist()
        blk, lo, hi, bucket, weight = (rows.column(c).to_numpy() for c in ("blk", "lo", "hi", "bucket", "weight"))
        ids = {v: i for i, v in enumerate(sorted(set(node)))}
        name = np.array([ids[v] for v in node])
        kinds = {v: i for i, v in enumerate(sorted(set(space)))}
        kind = np.array([kinds[v] for v in space])
        edge = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
        size = np.diff(np.append(edge, len(node)))
        count, ends = np.zeros(len(ids), dtype=np.int64), []
        for d in np.unique(length):  # a bucket holds vectors of one space, but for equal hashes
            own = np.flatnonzero(length == d)
            x = np.zeros((len(node), d))
            x[own] = unit(flat[starts[own][:, None] + np.arange(d)])
            rotations = int(round((1 + np.sqrt(1 + code_n[own[0]])) / 2)) - 1  # 4 k (1 + k) of them
            for a, b in _candidates(edge, size, blk, lo, hi, x, threshold):
                fine = (length[a] == d) & (length[b] == d) & (kind[a] == kind[b]) & (name[a] != name[b])
                a, b = a[fine], b[fine]
                for at in range(0, len(a), PAIRS):
                    p, q = a[at:at + PAIRS], b[at:at + PAIRS]
                    wide = np.arange(code_n[own[0]])
                    once = _in_first_bucket(codes[code_at[p][:, None] + wide], codes[code_at[q][:, None] + wide], bucket[p], rotations)
                    p, q = p[once], q[once]
                    np.add.at(count, name[p], weight[q])
                    np.add.at(count, name[q], weight[p])
                    ends.append((name[p], name[q]))
        if not ends:
            return
        a, b = (np.concatenate([e[i] for e in ends]) for i in (0, 1))
        linked = np.unique(np.concatenate([a, b]))
        root = _lowest(len(ids), a, b)
        names = list(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array([names[i] for i in linked], pa.binary()), pa.array(count[linked]),
             pa.array([names[i] for i in root[linked]], pa.binary())], names=["node", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        many = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            many += batch.num_rows
            if many < 4 * BLOCK:
                continue
            table = pa.Table.from_batches(held)
            cell = [table.column(c).to_numpy() for c in ("bucket", "lo", "hi")]
            cut = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cell]))
            if len(cut):  # the last cell may go on in the next batch
                at = int(cut[-1]) + 1
                yield from solve(table.slice(0, at))
                table = table.slice(at)
            held, many = table.to_batches(), table.num_rows
        if many:
            yield from solve(pa.Table.from_batches(held))

    return run


def _candidates(edge: np.ndarray, size: np.ndarray, blk: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray,
                threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the pairs of a cell whose cosine reaches the threshold."""
    small = (size > 1) & (size <= SMALL) & (lo[edge] == hi[edge])
    for many in np.unique(size[small]):
        i, j = np.triu_indices(many, 1)
        first = edge[small & (size == many)]
        a, b = (first[:, None] + i).ravel(), (first[:, None] + j).ravel()
        for at in range(0, len(a), PAIRS):
            p, q = a[at:at + PAIRS], b[at:at + PAIRS]
            near = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
            yield p[near], q[near]
    for first, many in zip(edge[(size > 1) & ~small], size[(size > 1) & ~small], strict=True):
        rows = np.arange(first, first + many)
        left = rows[blk[rows] == lo[first]]
        right = left if lo[first] == hi[first] else rows[blk[rows] == hi[first]]
        a, b = np.nonzero(x[left] @ x[right].T >= threshold)
        if lo[first] == hi[first]:
            a, b = a[a < b], b[a < b]
        yield left[a], right[b]


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest number joined to each of n numbers by the links a, b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for at in (a, b, root[a], root[b]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


def bucket_links(nodes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, salts: int = SALTS) -> DataFrame:
    """(node, n, root) per vector and group of cells in which it has links.

    ``nodes``: node, weight, payload, space and buckets, materialised.
    """
    spots = nodes.select(F.explode("buckets").alias("bucket"), "node")
    shared = materialize(spots.repartitionByRange("bucket", "node").sortWithinPartitions("bucket")
                         .mapInArrow(_shared_buckets, "bucket long, node binary"), "shared-buckets")
    # a bucket's rows are counted, and meet with their number, by salt
    salted = shared.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int"))
    sizes = (salted.groupBy("bucket", "salt").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
             .agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts")).where(F.col("n") > 1)
             .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"), F.explode("salts").alias("salt")))
    cells = (salted.join(sizes, ["bucket", "salt"])
             .withColumn("blk", F.pmod(F.xxhash64(F.lit(1), "node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("bucket", "node", "blk", F.least("blk", "other").alias("lo"), F.greatest("blk", "other").alias("hi")))
    rows = (cells.join(nodes, "node").select("bucket", "lo", "hi", "blk", "node", "weight", "space", "payload", "buckets")
            .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi", "node"))
    out = materialize(rows.mapInArrow(_compare(threshold), "node binary, n long, root binary"), "vector-links")
    discard(shared)
    return out


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = SEED) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors``.

    ``vectors`` has vec_id, embedding (array of float or double) and label.
    """
    base = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("payload"), "label")
    fine = (F.col("label").isNotNull() & (F.size("payload") > 0)
            & F.forall("payload", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("payload", lambda x: x != 0))
    # a null condition (null vector) counts as not fine; adding 0.0 turns -0.0 into 0.0
    content = F.concat_ws(":", F.col("label").cast("string"), F.array_join(
        F.transform("payload", lambda x: (x + F.lit(0.0)).cast("string")), ","))
    rows = base.withColumn("node", F.when(F.coalesce(fine, F.lit(False)), F.unhex(F.md5(content))))
    ids = materialize(rows.select("vec_id", "node"), "vector-ids")
    space = F.concat_ws(":", F.col("label").cast("string"), F.size("payload").cast("string"))
    classes = materialize(
        rows.where(F.col("node").isNotNull()).groupBy("node")
        .agg(F.count(F.lit(1)).alias("weight"), F.first("payload").alias("payload"), F.first(space).alias("space")), "vector-classes")
    largest = classes.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    nodes = materialize(classes.withColumn("space_hash", F.xxhash64("space")).mapInArrow(
        _hash_batches(largest, seed), "node binary, weight long, payload array<double>, space string, buckets array<long>"), "vector-buckets")
    found = bucket_links(nodes, threshold)
    comp = connected_components(found.where(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("node").agg(F.sum("n").alias("n")).join(comp, "node", "left")
    # the rows of one content, and the contents of one component, meet their totals by salt
    dealt = ids.withColumn("_salt", salt("vec_id"))
    per_node = (salted_totals(dealt, "node", [F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("low")],
                              [F.sum("weight").alias("weight"), F.min("low").alias("low")])
                .where(F.col("node").isNotNull()).join(linked, "node", "left")
                .select("node", "_salts", "low", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                        F.coalesce("root", "node").alias("root")))
    per_node = with_totals(per_node, "root", "node", [F.min("low").alias("lowest")], [F.min("lowest").alias("lowest")])
    named = dealt.join(by_salt(per_node), ["node", "_salt"], "left")
    discard(nodes)
    return (named.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                         F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("lowest")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))

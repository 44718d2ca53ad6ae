"""Self-join of documents on the Jaccard similarity of word shingles.

A shingle is a run of five words (a text of one to four words is one shingle).
Documents with equal shingle sets form a class. Class members become
candidates when they agree on one of ``BANDS`` bands, each a fixed random
choice of ``BAND_SIZE`` out of ``HASHES`` MinHash values: a pair at 0.8 agrees
on at least one band with probability 0.999995, one at 0.9 practically always.
Candidates are compared ``STEP`` MinHash values at a time: with m agreements
in n values and a uniform prior the similarity has a Beta(m + 1, n - m + 1)
posterior, and a pair is dropped once the probability of reaching the
threshold falls below ``TOLERANCE``. The rest is verified on the whole shingle
sets.

Cases: a null text counts as empty; texts without a word have no shingle and
link with nothing. A row without an id takes no part; it is its own class
(class_id null, no links). Rows that repeat count as copies of each other.
Words keep their case. Other input columns are ignored by ``jaccard_classes``
and kept by ``one_per_class``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm import linking
from trendflow.llm.common import discard, materialize, read_table, words

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 256
BANDS = 64
BAND_SIZE = 7
STEP = 32
TOLERANCE = 1e-7
SEED = 6
_CHUNK = 2048  # shingles hashed at a time, so that long texts stay in cache


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RNG = np.random.default_rng(SEED)
_POSITION = _RNG.integers(1, 2**63, size=SHINGLE, dtype=np.uint64) | np.uint64(1)
_FACTOR = _RNG.integers(1, 2**31, size=HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFT = _RNG.integers(0, 2**32, size=HASHES, dtype=np.uint32)
_BAND = np.stack([_RNG.choice(HASHES, size=BAND_SIZE, replace=False) for _ in range(BANDS)])
_BAND_FACTOR = _RNG.integers(1, 2**63, size=BAND_SIZE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(flat: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, from its words' hashes."""
    w = flat.view(np.uint64)
    runs = np.zeros(max(0, len(w) - SHINGLE + 1), dtype=np.uint64)
    for k in range(SHINGLE):
        runs += _mix(w[k:k + len(runs)]) * _POSITION[k]
    runs = _mix(runs)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(runs[a:b - SHINGLE + 1])
        elif b > a:
            short = _mix(w[a:b]) * _POSITION[:b - a]
            yield _mix(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield w[:0]


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, 2**32 - 1, dtype=np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(x), _CHUNK):
        np.minimum(low, (_FACTOR[:, None] * x[None, at:at + _CHUNK] + _SHIFT[:, None]).min(axis=1), out=low)
    return low


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """(rows, BANDS) bucket numbers of (rows, HASHES) MinHash values."""
    picked = signatures[:, _BAND].astype(np.uint64)
    return _mix((picked * _BAND_FACTOR).sum(axis=2, dtype=np.uint64) + _mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
                ).view(np.int64)


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    sizes = np.diff(column.offsets.to_numpy())
    return flat, np.concatenate([[0], np.cumsum(sizes)])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, low = [], []
        for shingles in shingle_sets(*_lists(batch, "words")):
            nodes.append(_digest(shingles) if len(shingles) else None)
            low.append(min_hashes(shingles))
        keys = band_keys(np.stack(low)) if low else np.zeros((0, BANDS), dtype=np.int64)
        bands = pa.ListArray.from_arrays(pa.array(np.arange(len(nodes) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.binary()), bands],
                                         names=["doc_id", "text_hash", "node", "bands"])


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(*_lists(batch, "words")))
        same = [i for i, (s, node) in enumerate(zip(sets, batch.column("node").to_pylist(), strict=True)) if _digest(s) == node]
        yield pa.RecordBatch.from_arrays(
            [batch.column("node").take(pa.array(same, pa.int64())), batch.column("weight").take(pa.array(same, pa.int64())),
             pa.array([sets[i].tobytes() for i in same], pa.binary())], names=["node", "weight", "payload"])


def tail(agree: int, n: int, threshold: float) -> float:
    """P(similarity >= threshold) after ``agree`` of ``n`` equal values.

    The upper tail of Beta(agree + 1, n - agree + 1) is the chance of at most
    ``agree`` successes in n + 1 trials.
    """
    return sum(math.exp(math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n + 2 - k)
                        + k * math.log(threshold) + (n + 1 - k) * math.log1p(-threshold)) for k in range(agree + 1))


def least_agreements(threshold: float, tolerance: float) -> dict[int, int]:
    """After each step of values, the fewest agreements a pair may have."""
    return {n: next(m for m in range(n + 1) if tail(m, n, threshold) >= tolerance) for n in range(STEP, HASHES + 1, STEP)}


def jaccard_links(threshold: float = THRESHOLD, tolerance: float = TOLERANCE):
    least = least_agreements(threshold, tolerance)

    def compare(loads: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in loads]
        low = np.stack([min_hashes(s) for s in sets])
        a, b = np.nonzero(np.ones((len(left), len(right)), dtype=bool))
        agree = np.zeros(len(a), dtype=np.int32)
        for n, fewest in least.items():
            part = slice(n - STEP, n)
            for at in range(0, len(a), 1 << 16):
                rows = slice(at, at + (1 << 16))
                agree[rows] += (low[left[a[rows]], part] == low[right[b[rows]], part]).sum(axis=1, dtype=np.int32)
            alive = agree >= fewest
            a, b, agree = a[alive], b[alive], agree[alive]
        hit = np.zeros((len(left), len(right)), dtype=bool)
        rows, cols = np.unique(a), np.unique(b)
        if len(rows):
            common = _intersections([sets[i] for i in left[rows]], [sets[i] for i in right[cols]])
            size_a = np.array([len(sets[i]) for i in left[rows]])[:, None]
            size_b = np.array([len(sets[i]) for i in right[cols]])[None, :]
            exact = common >= threshold * (size_a + size_b - common) - 1e-9
            keep = np.zeros_like(hit)
            keep[a, b] = True
            hit[np.ix_(rows, cols)] = exact
            hit &= keep
        return hit

    return compare


def _intersections(left: list, right: list, width: int = 8192) -> np.ndarray:
    """Sizes of all intersections, over the shingles found on both sides."""
    shared = np.intersect1d(np.concatenate(left), np.concatenate(right))
    out = np.zeros((len(left), len(right)))
    for at in range(0, len(shared), width):
        part = shared[at:at + width]
        out += _incidence(left, part) @ _incidence(right, part).T
    return out


def _incidence(sets: list, part: np.ndarray) -> np.ndarray:
    m = np.zeros((len(sets), len(part)), dtype=np.float32)
    for i, s in enumerate(sets):
        s = s[np.searchsorted(s, part[0]):np.searchsorted(s, part[-1], side="right")]
        at = np.searchsorted(part, s)
        m[i, at[part[at] == s]] = 1
    return m


def _with_words(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("words"))


def jaccard_classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """(doc_id, class_id, n_links) per row: the smallest id reachable through
    links, and the number of other rows of similarity >= ``threshold``."""
    return _classes(docs, threshold, tolerance).select("doc_id", "class_id", "n_links")


def _classes(docs: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``jaccard_classes`` with text_hash, node (null without an id or a word)
    and root, which tells classes of equal class_id apart."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = materialize(_with_words(base, "doc_id", F.xxhash64("text").alias("text_hash")).mapInArrow(
        _sketch, "doc_id long, text_hash long, node binary, bands array<long>"), "sketches")
    classes = materialize(
        sketched.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull()).groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("weight")), "classes")
    # the bands of one document of each class
    buckets = materialize(
        sketched.join(classes.select("node", "doc_id"), ["node", "doc_id"])
        .select(linking.short().alias("id"), F.explode("bands").alias("bucket")), "bands")
    ids = materialize(sketched.select("doc_id", "text_hash", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node")), "ids")
    discard(sketched)
    proposed = linking.candidate_clusters(buckets)
    clusters = materialize(proposed, "clusters")
    discard(buckets, *proposed.held)
    wanted = (classes.withColumn("id", linking.short()).join(clusters, "id", "left_semi").select("node", "weight", "doc_id"))
    payload = (_with_words(base.join(wanted, "doc_id"), "node", "weight")
               .mapInArrow(_payload, "node binary, weight long, payload binary"))
    linked = linking.links(clusters, payload, jaccard_links(threshold, tolerance))
    per_class = materialize(
        classes.join(linked, "node", "left").select(
            "node", "doc_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root")), "class-links")
    discard(classes, clusters, *linked.held)
    lowest = per_class.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    per_class = per_class.join(lowest, "root").select("node", "root", "n_links", "class_id")
    return (ids.join(per_class, "node", "left")
            .select("doc_id", "text_hash", "node", "root", F.coalesce("class_id", "doc_id").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def one_per_class(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the smallest doc_id, once
    (of its texts in the class that of the smallest node), each text without a
    word once an id, and every row without an id. Texts that share an id and are
    no near copies stay each. All columns stay.
    """
    found = _classes(docs, threshold, TOLERANCE).where(F.col("doc_id").isNotNull())
    lowest = (found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct("doc_id", "node", "text_hash")).alias("low"))
              .select("low.doc_id", "low.text_hash"))
    kept = lowest.unionByName(found.where(F.col("root").isNull()).select("doc_id", "text_hash").distinct())
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"))
    whole = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct("*").alias("row"))
    # rows of equal id and text may differ elsewhere: the first by all columns that have an order
    ordered = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    stay = (whole.join(kept, (whole["doc_id"] == kept["kept_id"]) & (whole["text_hash"] == kept["kept_hash"]), "left_semi")
            .groupBy("doc_id", "text_hash").agg(F.min_by("row", F.struct(*[f"row.{c}" for c in ordered])).alias("row")).select("row"))
    return stay.unionByName(whole.where(F.col("doc_id").isNull()).select("row")).select("row.*")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(read_table(spark, sf_dir, "documents"))

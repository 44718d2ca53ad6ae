"""Embedding near-dedup: cases beyond the comparison with all pairs."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendflow.llm import embedding_dedup as dedup
from trendflow.llm.common import read_table

SCHEMA = "vec_id long, embedding array<double>, label int, node string, n int, payload string, bucket long"


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(k, v, lab, "x", 1, "y", 2) for k, v, lab in rows], SCHEMA).repartition(parts)
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in dedup.near_duplicates(df).collect()}


def all_pairs(rows, threshold=0.98):
    x = dedup.unit(np.array([v for _, v, _ in rows], dtype=float))
    label = np.array([lab for *_, lab in rows])
    hit = (x @ x.T >= threshold) & (label[:, None] == label[None, :]) & ~np.eye(len(rows), dtype=bool)
    root = np.arange(len(rows))
    for _ in rows:
        new = np.where(hit, root[None, :], len(rows)).min(axis=1).clip(max=root)
        if (new == root).all():
            break
        root = new
    ids = [k for k, *_ in rows]
    return {ids[i]: (int(hit[i].sum()), ids[root[i]], root[i] == i) for i in range(len(rows))}


@pytest.mark.parametrize(("block", "small"), [(512, 24), (4, 2), (16, 0)])
def test_one_dense_group_against_all_pairs(spark, monkeypatch, block, small):
    """A group in one bucket is dealt over blocks, and every link counts once."""
    monkeypatch.setattr(dedup, "SMALL", small)
    monkeypatch.setattr(dedup.bucket_links, "__defaults__", (dedup.THRESHOLD, block, 3))
    r = np.random.default_rng(7)
    base = r.normal(size=32)
    rows = [(k, (base + r.uniform(0.02, 0.22) * r.normal(size=32)).tolist(), 1) for k in range(120)]
    rows += [(k, r.normal(size=32).tolist(), k % 2) for k in range(200, 260)]
    got, want = run(spark, rows), all_pairs(rows)
    assert got == want
    assert max(n for n, *_ in want.values()) > 60


def test_magnitudes(spark):
    v = np.array([1.0, 2.0, -3.0, 0.5])
    other = np.array([1.0, -2.0, 3.0, 0.5])
    rows = [(i, (s * x).tolist(), 1) for i, (s, x) in enumerate(
        [(1e200, v), (1e200, v), (1e-200, v), (1e-300, v), (1, v), (1e300, v), (1e200, other), (1e-200, other)])]
    got = run(spark, rows)
    assert all(got[i] == (5, 0, i == 0) for i in range(6))
    assert got[6] == (1, 6, True) and got[7] == (1, 6, False)


def test_cases(spark):
    assert run(spark, []) == {}
    got = run(spark, [(None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1), (5, [1.0, 2.0, 0.0], 1), (6, [1.0, 2.0], 2), (7, None, 1), (7, None, 1), (4, [1.0, 2.0], 1)])
    assert got[4] == (2, 4, True) and got[None] == (2, 4, False)
    assert got[5] == (0, 5, True) and got[6] == (0, 6, True) and got[7] == (0, 7, True)


def test_unrelated_vectors_are_not_compared():
    """Of 50,000 random vectors of one label under 1 % of all pairs share a bucket."""
    n, d = 50_000, 64
    x = dedup.unit(np.random.default_rng(5).normal(size=(n, d)))
    k = dedup.rotations_for(n, d)
    codes = np.concatenate([dedup.probes(x[at:at + 10_000], k) for at in range(0, n, 10_000)])
    _, size = np.unique(codes, return_counts=True)
    assert (size * (size - 1) // 2).sum() < 0.0001 * n * (n - 1) / 2  # an upper bound: pairs may share several


@pytest.mark.parametrize("n", [1, 10**5, 10**8])
def test_recall_of_all_tables(n):
    """Pairs of cosine 0.98 meet, however many hashes a table has."""
    r = np.random.default_rng(6)
    x = dedup.unit(r.normal(size=(400, 64)))
    off = r.normal(size=x.shape)
    off = dedup.unit(off - (off * x).sum(axis=1, keepdims=True) * x)
    k = dedup.rotations_for(n, 64)
    a, b = dedup.probes(x, k), dedup.probes(0.98 * x + np.sqrt(1 - 0.98**2) * off, k)
    a, b = (v.reshape(len(v), -1, 1 + k) for v in (a, b))
    assert (a[:, :, :, None] == b[:, :, None, :]).any(axis=(1, 2, 3)).all()


@pytest.mark.skipif(not os.path.exists("/root/testdata/check_s"), reason="the table with planted neighbours is not here")
def test_recall_on_the_given_table(spark):
    """Vectors whose id is divisible by 20 against all vectors."""
    sf = "/root/testdata/check_s"
    table = read_table(spark, sf, "embeddings")
    rows = [r for r in table.collect() if r.label is not None and r.embedding and all(v is not None and np.isfinite(v) for v in r.embedding)
            and any(r.embedding)]
    x = dedup.unit(np.array([r.embedding for r in rows], dtype=float))
    label, ids = np.array([r.label for r in rows]), np.array([r.vec_id for r in rows])
    query = np.flatnonzero(ids % 20 == 0)
    links = {int(ids[q]): int(((x @ x[q] >= 0.98) & (label == label[q])).sum()) - 1 for q in query}
    got = {r.vec_id: r.n_links for r in dedup.near_duplicates(table).where(F.col("vec_id") % 20 == 0).collect()}
    assert sum(links.values()) > 0
    assert {k: got[k] for k in links} == links  # recall and precision 1

"""Filter audit against a plain run of all orders, and its cases."""

import collections
import itertools
import re

import pytest

from trendflow.llm import filter_audit as audit

DOCS = "doc_id long, text string, source string, part string, mask int, labels string"
LABELS = "doc_id long, quality int, toxic int"


def plain(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(r[0], first.get(r[1] or "", r[0]))
    docs = []
    for r in rows:
        key, t, part = r[0], r[1] or "", r[2] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": re.search(r"[#$%&*|]", t) is not None, "E": key is not None and first[t] < key}
        docs.append((part, {k for k, v in fails.items() if v}, key in good, key in toxic))
    out = {}
    shapley = collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {d[0] for d in docs}:
            left = [d for d in docs if d[0] == part]
            whole = list(left)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                fail = [d for d in whole if f in d[1]]
                out[part, order, step] = (len(left), len(gone), len(fail) - len(gone), sum(d[1] == {f} for d in whole),
                                          sum(d[2] for d in gone), sum(d[3] for d in gone))
                shapley[part, f] += len(gone)
    return {k: v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}


def run(spark, rows, labels, parts=3):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], DOCS).repartition(parts)
    got = audit.orders(audit.combinations(docs, spark.createDataFrame(labels, LABELS))).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
             for r in got}
    assert len(found) == len(got)
    return found


WORDY = " ".join(f"term{i}" for i in range(300))
TEXTS = [None, "", "short", WORDY, WORDY + " #", WORDY.upper(), "same " * 400, "SAME & " * 250, WORDY + " tail", " \t\n" * 50, " wide x"]


def test_against_plain(spark):
    rows = [(k, TEXTS[(k * 7 + k // 3) % len(TEXTS)], [None, "", "a", "b"][k % 4]) for k in range(90)]
    rows += [(None, WORDY, "a"), (None, "only here", None), (5, "another text of id 5", "a"), (7, WORDY, "b"), rows[8], rows[8]]
    labels = [(k, k % 2, int(k % 5 == 0)) for k in range(0, 90, 2)] + [(4, None, None), (4, 1, 1), (None, 1, 1), (6, 0, 0)]
    assert run(spark, rows, labels) == plain(rows, labels)


@pytest.mark.parametrize("salts", [1, 3])
def test_one_text_in_most_rows(spark, monkeypatch, salts):
    monkeypatch.setattr(audit.later_copies, "__defaults__", (salts,))
    rows = [(k, WORDY if k % 3 else f"{WORDY} {k}", "hot" if k % 3 else "a") for k in range(300)]
    assert run(spark, rows, [(1, 1, 0), (2, 1, 1)], parts=7) == plain(rows, [(1, 1, 0), (2, 1, 1)])


def test_empty_tables(spark):
    assert run(spark, [], []) == {}
    assert run(spark, [(1, "x", "a")], []) == plain([(1, "x", "a")], [])

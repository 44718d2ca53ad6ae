"""URL verdicts from a tree of path templates per host.

Paths become templates: segments that are numbers, hexadecimal or mixed ids
become wildcards by form (a file's extension stays). At every node of a host's
tree the children whose labelled shares of bad pages do not differ from the
rest of their siblings (two-proportion z below ``SIMILAR``) become one
wildcard, and their own children of the same name become one; a child that
differs stays a branch of its own, however many siblings it has. A node's share
of bad labels, over all pages below it, is smoothed by ``PRIOR`` pages of the
share of its parent's other pages (a host's by the corpus' share), so that
every label counts once. A page is rejected when the share at the end of its
path reaches ``REJECT``. Hand-made rules override the tree; the longest wins.

The tree is built on counts per (host, path by form), pre-aggregated before
the shuffle, so a host with a third of all pages is a few rows. It goes as deep
as the paths do; a node whose labels are all alike has only similar children,
so its paths are settled there. A node whose paths have at most ``IN_TASK``
segments together is built to the end in one task, however deep; only larger
ones go down by an aggregate per depth, until what is below them is that small.

Cases: a url that is null or has no ``://`` has empty host and path and no
rule. An unlabelled branch takes the share of its parent; a host without any
label is allowed. A page labelled twice counts as bad if any label says so.
Repeated rows are judged alike and counted each time. Null ids have no label.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import discard, materialize, read_table

SIMILAR = 2.58
PRIOR = 10.0
REJECT = 0.5
#: Segments of all paths below a node, up to which one task builds its tree.
IN_TASK = 500_000
#: (verdict, host, path) of the contract's rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def by_form(path: Column) -> Column:
    """Segments with variable ones replaced by wildcards, at every depth."""
    def shape(s: Column) -> Column:
        ext = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        stem = F.regexp_replace(s, r"\.[A-Za-z]{1,5}$", "")
        wild = (F.when(stem.rlike(r"^[0-9]+$"), "{n}").when(stem.rlike(r"^(?i)[0-9a-f-]{8,}$"), "{h}")
                .when(stem.rlike(r"^(?=.*[0-9])[\w-]+$"), "{s}").otherwise(stem))
        return F.concat(wild, ext)

    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    return F.transform(parts, shape)


_END, _REST = "/", "*/"  # the end of a path, and the wildcard of similar children: no segment holds a slash


def settle(forms: list, bad: list[int], labelled: list[int], p_bad: int, p_n: int, prior_share: float, depth: int,
           prior: float, reject: float, similar: float) -> list[int]:
    """The rows that are blocked below one node of a tree, to any depth: the same
    steps as those of ``_descend``, over a node's rows in memory."""
    blocked, todo = [], [(range(len(forms)), depth, p_bad, p_n, prior_share)]
    while todo:
        rows, depth, p_bad, p_n, prior_share = todo.pop()
        share = (p_bad + prior * prior_share) / (p_n + prior)
        mixed = 0 < p_bad < p_n
        children: dict = {}
        for i in rows:
            if mixed and len(forms[i]) >= depth:
                children.setdefault(forms[i][depth] if len(forms[i]) > depth else _END, []).append(i)
            elif share >= reject:
                blocked.append(i)
        groups: dict = {}
        for segment, own in children.items():
            b, n = sum(bad[i] for i in own), sum(labelled[i] for i in own)
            rest_b, rest_n = p_bad - b, p_n - n
            differs = False
            if n and rest_n:
                spread = math.sqrt(share * (1 - share) * (1 / n + 1 / rest_n))
                differs = spread > 0 and abs(b / n - rest_b / rest_n) / spread > similar
            group = groups.setdefault(segment if differs else _REST, [[], 0, 0])
            group[0] += own
            group[1] += b
            group[2] += n
        for own, b, n in groups.values():
            todo.append((own, depth + 1, b, n, (p_bad - b + prior * prior_share) / (p_n - n + prior)))
    return blocked


def _settled(rows: DataFrame, depth: int, prior: float, reject: float, similar: float) -> DataFrame:
    """(host, form) blocked below the nodes of ``rows``, a node in one task."""
    def one(node: pd.DataFrame) -> pd.DataFrame:
        node = node.reset_index(drop=True)
        first = node.iloc[0]
        forms = [list(f) for f in node["form"]]
        at = settle(forms, node["bad"].tolist(), node["labelled"].tolist(), int(first["p_bad"]), int(first["p_n"]),
                    float(first["prior"]), depth, prior, reject, similar)
        return pd.DataFrame({"host": pd.Series([first["host"]] * len(at), dtype=object),
                             "form": pd.Series([forms[i] for i in at], dtype=object)})

    return rows.groupBy("host", "node").applyInPandas(one, "host string, form array<string>")


def _descend(rows: DataFrame, depth: int, prior: float, similar: float) -> DataFrame:
    """The rows of open nodes at their children, similar ones of which are one."""
    share = (F.col("p_bad") + prior * F.col("prior")) / (F.col("p_n") + prior)
    rows = rows.withColumn("segment", F.coalesce(F.get("form", F.lit(depth)), F.lit(_END)))
    children = (rows.groupBy("host", "node", "segment").agg(
        F.sum("bad").alias("bad"), F.sum("labelled").alias("n"),
        *[F.first(c).alias(c) for c in ("p_bad", "p_n", "prior")]))
    n, rest_bad, rest_n = F.nullif(F.col("n"), F.lit(0)), F.col("p_bad") - F.col("bad"), F.nullif(F.col("p_n") - F.col("n"), F.lit(0))
    spread = F.sqrt(share * (1 - share) * (1 / n + 1 / rest_n))
    z = F.abs(F.col("bad") / n - rest_bad / rest_n) / F.nullif(spread, F.lit(0.0))
    children = children.withColumn("group", F.when(F.coalesce(z > similar, F.lit(False)), F.col("segment")).otherwise(_REST))
    merged = (children.groupBy("host", "node", "group").agg(
        F.sum("bad").alias("g_bad"), F.sum("n").alias("g_n"), *[F.first(c).alias(c) for c in ("p_bad", "p_n", "prior")]))
    # smoothed by the parent's other pages, and those by the parent's own prior
    others = (F.col("p_bad") - F.col("g_bad") + prior * F.col("prior")) / (F.col("p_n") - F.col("g_n") + prior)
    merged = merged.select("host", "node", "group", F.col("g_bad").alias("p_bad"), F.col("g_n").alias("p_n"), others.alias("prior"))
    steps = children.select("host", "node", "segment", "group").join(merged, ["host", "node", "group"])
    return (rows.drop("p_bad", "p_n", "prior").join(steps, ["host", "node", "segment"])
            .withColumn("node", F.xxhash64("node", "group")).drop("segment", "group"))


def rejected(counts: DataFrame, prior: float = PRIOR, reject: float = REJECT, similar: float = SIMILAR,
             in_task: int = IN_TASK) -> DataFrame:
    """(host, form) of the paths to block."""
    counts = materialize(counts, "url-counts")
    whole = counts.agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("n")).first()
    if not whole["n"]:
        return counts.select("host", "form").limit(0)
    hosts = (counts.groupBy("host").agg(F.sum("bad").alias("p_bad"), F.sum("labelled").alias("p_n")).where("p_n > 0")
             .withColumn("prior", F.lit(whole["bad"] / whole["n"])))
    share = (F.col("p_bad") + prior * F.col("prior")) / (F.col("p_n") + prior)
    # a row's node: its key, its labels, and the share it is smoothed by
    rows = counts.join(hosts, "host").withColumn("node", F.lit(0).cast("long"))
    done, depth, held = [], 0, counts
    while True:
        segments = rows.groupBy("host", "node").agg(F.sum(F.size("form") + 1).alias("segments"))
        mixed = (F.col("p_bad") > 0) & (F.col("p_bad") < F.col("p_n"))
        # paths of a node whose labels are all alike, or that end above, are judged by it
        state = (F.when(~(mixed & (F.size("form") >= depth)), F.when(share >= reject, "blocked").otherwise("allowed"))
                 .when(F.col("segments") > in_task, "open").otherwise("small"))
        rows = materialize(rows.join(segments, ["host", "node"]).withColumn("state", state).drop("segments"), "url-tree")
        discard(held)
        held = rows
        blocked = rows.where("state = 'blocked'").select("host", "form").unionByName(
            _settled(rows.where("state = 'small'"), depth, prior, reject, similar))
        done.append(materialize(blocked, "url-blocked"))
        rows = rows.where("state = 'open'").drop("state")
        if rows.isEmpty():
            discard(held)
            break
        rows = _descend(rows, depth, prior, similar)
        depth += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def judge(urls: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(id, host, path, rule, verdict) per row of ``urls`` (id, url);
    ``labels``: (id, bad boolean)."""
    parts = urls.select(F.col("id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumn("form", by_form(F.col("path")))
    marks = labels.where(F.col("id").isNotNull()).groupBy("id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    counts = (parts.join(marks, "id", "left").groupBy("host", "form")
              .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("labelled")))
    blocked = rejected(counts).withColumn("blocked", F.lit(True))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learnt = F.when(F.col("blocked"), "block").otherwise("allow")
    return (parts.join(blocked, ["host", "form"], "left")
            .select("id", "host", "path", rule.alias("rule"), F.coalesce(verdict, learnt).alias("verdict")))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url")
    labels = read_table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return judge(pages, labels).withColumnRenamed("id", "page_id")

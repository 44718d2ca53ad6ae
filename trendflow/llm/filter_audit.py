"""Audit of how filters interact in every order in which they could run.

Each filter's failing documents are ids of their own; only the filter on exact
copies needs other rows. It is an existential self-join: a left-semi join on
the hash, the exact text and a smaller id marks a document that has an earlier
copy. The union of all failing ids, one bit per filter, is folded into one bit
combination per document. Whatever an order of filters does to a document
depends on its combination only, so the documents are counted once per
(part, combination) and all orders are worked out from those counts.

Skew: of a group of copies only the first of each text is joined to (one row
per hash and text, made by partial aggregation), and rows are dealt by hash and
a salt of their id, so that a hash that a third of all rows have is spread over
``SALTS`` tasks; a first row is copied to the salts that its group has.

Cases: a null text counts as empty, a null source as the part "". A null id is
smaller or larger than none, so its row is never a later copy (it is counted,
without labels). Rows that share an id are documents of their own; equal ones
are not each other's earlier copy. Of several labels of an id, any that says
so counts. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from trendflow.llm.common import discard, materialize, read_table, words

MIN_WORDS = 200
MIN_DISTINCT_PCT = 50
MAX_UPPER_PCT = 2
SIGNS = r"[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Tasks over which the rows of one hash are dealt.
SALTS = 64


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that a text alone decides."""
    w = words(text)
    n = F.size(w)
    return {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PCT * n,
        # the letters are what translate leaves out
        "C": 100 * (F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))) > MAX_UPPER_PCT * F.char_length(text),
        "D": text.rlike(SIGNS),
    }


def _salt(size: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(size)).cast("int").alias("salt")


def _dealt(groups: DataFrame, salts: str = "salts") -> DataFrame:
    """One row per salt that a group has."""
    return groups.withColumn("salt", F.explode(salts)).drop(salts)


def later_copies(docs: DataFrame, hashes: DataFrame, salts: int = SALTS) -> DataFrame:
    """(id, hash) of the rows whose exact text a smaller id has, once each.

    ``docs``: id (long), hash (of the text) and text; ``hashes``: their id and
    hash, materialised. ``held`` lists the scratch tables that the result reads.
    """
    small = hashes.where(F.col("id").isNotNull()).select("id", "hash", _salt(salts))
    shared = (small.groupBy("hash", "salt").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("hash").agg(F.sum("n").alias("n"), F.collect_list("salt").alias("salts"))
              .where(F.col("n") > 1).select("hash", "salts"))
    wanted = small.join(_dealt(shared), ["hash", "salt"], "left_semi").distinct()
    # by id, of which there is no hot one: texts of hashes that two rows share
    copies = materialize(docs.join(wanted, ["id", "hash"]), "copies")
    first = _dealt(copies.groupBy("hash", "text").agg(F.min("id").alias("first_id"), F.collect_set("salt").alias("salts")))
    first = first.withColumnsRenamed({"hash": "first_hash", "text": "first_text", "salt": "first_salt"})
    same = ((copies["hash"] == first["first_hash"]) & (copies["salt"] == first["first_salt"])
            & (copies["text"] == first["first_text"]) & (first["first_id"] < copies["id"]))
    out = copies.join(first, same, "left_semi").select("id", "hash").distinct()
    out.held = [copies]
    return out


def combinations(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text",
                 part: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters that they fail, bit
    i of ``mask`` being the i-th letter; ``good`` and ``toxic`` are those of them
    that ``labels`` (doc_id, quality, toxic) says so of."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(body, 256)).alias("hash"), body.alias("text"))
    fails = text_filters(F.col("text"))
    bits = reduce(lambda a, b: a + b, [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails.values())])
    # one small row per document: the texts are read for it once
    failing = materialize(rows.select("id", "hash", "part", bits.alias("bits")), "failing")
    copies = later_copies(rows.select("id", "hash", "text"), failing.select("id", "hash"))
    # union of ids: a document's rows, and a mark without a row of its own
    key_cols = ["id", "hash"]
    parts = F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "n")))
    alike = failing.groupBy(*key_cols, "part").agg(F.count(F.lit(1)).alias("n"), F.max("bits").alias("bits"))
    united = alike.unionByName(copies.select(*key_cols, F.lit(None).cast("string").alias("part"), F.lit(0).cast("long").alias("n"),
                                             F.lit(1 << len(fails)).alias("bits")))
    masks = (united.groupBy(*key_cols).agg(F.bit_or("bits").alias("mask"), parts.alias("parts"))
             .select("id", "mask", F.inline("parts")))
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    out = materialize(
        masks.join(marked, masks["id"] == marked["label_id"], "left")
        .groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.coalesce(F.col("n") * F.col("good"), F.lit(0))).alias("good"),
            F.sum(F.coalesce(F.col("n") * F.col("toxic"), F.lit(0))).alias("toxic")), "combinations")
    discard(failing, *copies.held)
    return out


def orders(counts: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """What every filter does at every step of every order of ``filters``, per
    part of ``counts`` (from ``combinations``)."""
    every = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = F.sequence(F.lit(1), F.lit(len(filters)))
    rows = (counts.select("*", F.explode(every).alias("filter_order"))
            .select("*", F.explode(steps).alias("step"))
            .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
            .withColumn("ahead", F.substring("filter_order", F.lit(1), F.col("step") - 1)))

    def bits_of(letters: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.contains(letters, F.lit(c)), 1 << i).otherwise(0) for i, c in enumerate(filters)])

    own, before = bits_of(F.col("letter")), bits_of(F.col("ahead"))
    rows = rows.withColumns({"fails": F.col("mask").bitwiseAND(own) != 0, "gone": F.col("mask").bitwiseAND(before) != 0,
                             "alone": F.col("mask") == own})
    removed = F.col("fails") & ~F.col("gone")

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(0))

    per_step = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total(~F.col("fails") & ~F.col("gone")).alias("kept"), total(removed).alias("removed"),
        total(F.col("fails") & F.col("gone")).alias("redundant"), total(F.col("alone")).alias("unique_fails"),
        total(removed, "good").alias("good_lost"), total(removed, "toxic").alias("toxic_lost"))
    # a letter stands once in every order: a window holds one row per order
    whole = Window.partitionBy("part", "letter")
    return per_step.withColumn("shapley", F.sum("removed").over(whole)).drop("letter")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(combinations(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")))


AUDIT_SQL = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id),
m AS (
  SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
                100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
                coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)] AS fail,
         coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM d LEFT JOIN lab ON d.doc_id = lab.doc_id),
c AS (SELECT part, fail, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fail),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
j AS (
  SELECT c.*, s.*, substr(filter_order, step, 1) AS letter, fail[ascii(substr(filter_order, step, 1)) - 64] AS fails,
         len(list_filter([1, 2, 3, 4, 5], lambda i: i < step AND fail[ascii(substr(filter_order, i, 1)) - 64])) > 0 AS gone,
         len(list_filter(fail, lambda f: f)) AS fail_count
  FROM c, s),
g AS (
  SELECT part, filter_order, step, letter,
         CAST(sum(CASE WHEN NOT fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN fails AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN fails AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN fails AND fail_count = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN fails AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN fails AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM j GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM g"""

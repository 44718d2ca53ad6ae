"""Fill-in-the-middle transformation by counted regular expressions.

A text is cut into units (runs of letters, or any other single code point) by
a pattern. ``regexp_count`` gives their number n; two draws from a hash of the
id choose where the prefix ends (after ``a`` units) and where the middle ends
(after ``b``). One match of a pattern made for the row,
``unit{a}`` ``unit{b-a}`` ``rest``, captures the three parts, and the
replacement of that match writes them in the order of the form:

    psm    <P>prefix<S>suffix<M>middle
    spm    <S>suffix<P>prefix<M>middle
    plain  the text as it is

The counted groups are possessive: the engine walks them in a loop, neither
stacking a frame per unit nor keeping places to return to, so a text may have
millions of units. Nothing is shuffled; each row is made from itself.

Cases: a null text counts as empty. An empty text and one that holds a marker
stay plain, so that ``restore`` is exact. A null id draws as the empty string
does. Repeated rows give equal results, each of its own. Other input columns
stay; columns that ``transform`` adds replace input columns of the same name.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import read_table

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: Markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Percent of documents that are transformed, and of those the percent in spm form.
RATE = 90
SPM = 20
SEED = 1


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 of a row's key: the first 8-digit groups of the
    SHA-256 of ``seed:key``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rate: int = RATE, spm: int = SPM,
              seed: int = SEED, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``docs`` with n (units), form, output, prefix_chars and middle_chars (code
    points; null for plain rows).

    ``markers`` must be three different strings that neither begin inside nor
    end inside one another, like the given ones.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(key), seed)
    n = F.regexp_count(body, F.lit(UNIT)).cast("long")
    rows = docs.withColumns({"n": n, "_h1": h1, "_h2": h2, "_h3": h3, "_h4": h4})
    held = F.lit(False)
    for m in markers:
        held = held | F.contains(body, F.lit(m))
    form = F.when((F.col("n") == 0) | held | (F.col("_h3") % 100 >= rate), "plain").when(F.col("_h4") % 100 < spm, "spm").otherwise("psm")
    first, second = F.col("_h1") % (F.col("n") + 1), F.col("_h2") % (F.col("n") + 1)
    rows = rows.withColumns({"form": form, "_a": F.least(first, second), "_b": F.greatest(first, second)})
    # possessive inside and outside: a unit is never given back
    unit = "(?:[A-Za-z]++|[^A-Za-z])"
    counted = [F.concat(F.lit(f"({unit}{{"), c.cast("string"), F.lit("}+)")) for c in (F.col("_a"), F.col("_b") - F.col("_a"))]
    pattern = F.concat(F.lit(r"(?s)\A"), *counted, F.lit(r"(.*+)\z"))
    p, s, m = (x.replace("\\", "\\\\").replace("$", "\\$") for x in markers)
    written = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    # a plain row's text is not matched at all
    output = F.when(F.col("form") == "plain", body).otherwise(F.regexp_replace(body, pattern, written))
    rows = rows.withColumn("output", output)
    parts = _parts(F.col("output"), F.col("form"), markers)
    return rows.withColumns({
        "prefix_chars": F.char_length(parts["prefix"]).cast("long"),
        "middle_chars": F.char_length(parts["middle"]).cast("long"),
    }).drop("_h1", "_h2", "_h3", "_h4", "_a", "_b")


def _parts(output: Column, form: Column, markers: tuple[str, str, str]) -> dict[str, Column]:
    """The three parts of an output (null for plain rows). No part holds a
    marker, so the first of each kind is the one that was written."""
    p, s, m = markers

    def between(first: str, second: str) -> Column:
        begin = F.char_length(F.lit(first)) + 1  # the output starts with it
        return F.substring(output, begin, F.instr(output, second) - begin)

    def behind(mark: str, stop: str | None) -> Column:
        begin = F.instr(output, mark) + len(mark)
        end = F.char_length(output) + 1 if stop is None else F.instr(output, stop)
        return F.substring(output, begin, end - begin)

    spm, psm = form == "spm", form == "psm"
    return {
        "prefix": F.when(spm, behind(p, m)).when(psm, between(p, s)),
        "middle": F.when(spm | psm, behind(m, None)),
        "suffix": F.when(spm, between(s, p)).when(psm, behind(s, m)),
    }


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output of ``transform`` was made from."""
    parts = _parts(output, form, markers)
    return F.when(form == "plain", output).otherwise(F.concat(parts["prefix"], parts["middle"], parts["suffix"]))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


FIM_SQL = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b FROM u),
f AS (
  SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                 WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM f"""

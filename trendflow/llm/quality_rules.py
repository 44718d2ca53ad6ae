"""Weak supervision of text quality: rules vote, EM weighs them.

Each rule votes for good text (+1), for bad text (-1) or abstains (0). The
votes of all documents are counted by pattern (at most 3 ** 8 patterns, so the
counts are bounded whatever the corpus; documents that fail the base test are left out),
and expectation-maximisation over these counts estimates, for each rule, how
often it votes each way on good and on bad text (Dawid and Skene's model, with
rules held to be no worse than chance). The posterior probability of good text
is then a sum of constants picked by the votes, i.e. one SQL expression.

Everything is DataFrame functions; features are computed inside the row,
without a shuffle, and once: counts, or the rows that may stay with their votes,
are written to scratch before the model is fitted.

Cases: a null text has no words and fails the base test. Rows that repeat are
judged alike. Nulls in other columns are kept; a column of the input named
like an output column is replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import materialize, read_table, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
KEEP_AT = 0.5
ROUNDS = 50
SMOOTHING = 1.0
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _windows(h: Column) -> Column:
    """64-bit hashes of the 5-word windows, from the words' hashes; null where
    the text has fewer words."""
    n = F.size(h)
    return F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))


def _recurring(placed: str) -> Column:
    """Sorted starts of the windows whose hash occurs elsewhere too, from the
    column of sorted (hash, start) pairs. A column, as a lambda that held the
    sort itself would run it once per element."""
    s = F.col(placed)
    same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["w"] == x["w"], F.lit(False))
                    | F.coalesce(F.get(s, k + 1)["w"] == x["w"], F.lit(False)))
    return F.array_sort(F.transform(same, lambda x: x["i"]))


def _covered(starts: Column) -> Column:
    """Number of words inside the windows at these starts."""
    zero = F.struct(F.lit(0).alias("sum"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, zero, lambda acc, x: F.struct(
        (acc["sum"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("sum"), x.alias("last")), lambda acc: acc["sum"])


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the base counts and the counts that the rules read."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn("_w", words(F.col(text)))
    df = df.withColumn("_lines", F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_win", _windows(F.col("_h")))
    df = df.withColumn("_placed", F.when(F.size(F.array_distinct("_win")) < F.size("_win"), F.array_sort(
        F.transform("_win", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))))
    n = F.size("_w")
    df = df.select(
        *[F.col(c) for c in docs.columns if c.lower() not in _ADDED],
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_covered(_recurring("_placed")), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_h", lambda x, i: F.coalesce(F.get("_h", i - 1) == x, F.lit(False)))).cast("long").alias("n_stutters"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(t, F.lit(r"!!")).cast("long").alias("n_shouts"),
        F.regexp_count(t, F.lit(r"[.?!]")).cast("long").alias("n_stops"),
        F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\p{N}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])")).cast("long").alias("n_bare"),
    )
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    # the second term is never true; as it is not deterministic, filters on base_failed stay above
    # this projection instead of repeating the features' expressions, lambdas included, below it
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | repeats | (F.spark_partition_id() < 0))


_COUNTS = (*BASE, "n_lines", "n_upper", "n_shouts", "n_stops", "n_bare", "n_stutters")
_ADDED = {*_COUNTS, "base_failed", "kept", "quality_posterior", "_w", "_h", "_lines", "_win", "_placed"}


def _vote(value: Column, good: Column, bad: Column) -> Column:
    return F.when(value.isNull(), 0).when(bad, -1).when(good, 1).otherwise(0)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.nullif(F.col(whole), F.lit(0))


def _by(value: Column, good_to: float, bad_from: float) -> Column:
    return _vote(value, value <= good_to, value >= bad_from)


def rules() -> dict[str, Column]:
    """Name -> vote in (-1, 0, 1) over the columns of ``with_features``."""
    mean = _share("word_chars", "n_words")
    return {
        "symbols": _by(_share("n_symbols", "n_words"), 0.02, 0.1),
        "capitals": _by(_share("n_upper", "word_chars"), 0.15, 0.4),
        "shouts": _by(_share("n_shouts", "n_words"), 0.01, 0.1),
        "bare_signs": _by(_share("n_bare", "n_words"), 0.02, 0.15),
        "word_length": _vote(mean, mean.between(3, 12), (mean < 2) | (mean > 20)),
        "same_lines": _by(_share("n_dup_lines", "n_lines"), 0.1, 0.4),
        "stutters": _by(_share("n_stutters", "n_words"), 0.02, 0.2),
        "sentences": _by(_share("n_words", "n_stops"), 40, 400),
    }


class VoteModel:
    """Chance of each vote on good and on bad text, and of bad text."""

    def __init__(self, bad: float, on_good: list[dict], on_bad: list[dict]):
        self.bad, self.on_good, self.on_bad = bad, on_good, on_bad

    def accuracies(self) -> list[float]:
        """For each rule, how often it is right when it votes."""
        out = []
        for g, b in zip(self.on_good, self.on_bad, strict=True):
            right = (1 - self.bad) * g[1] + self.bad * b[-1]
            wrong = (1 - self.bad) * g[-1] + self.bad * b[1]
            out.append(right / (right + wrong))
        return out

    def log_odds(self, pattern) -> float:
        return math.log((1 - self.bad) / self.bad) + sum(
            math.log(g[v] / b[v]) for v, g, b in zip(pattern, self.on_good, self.on_bad, strict=True))

    def posterior(self, votes: list[Column]) -> Column:
        """Probability of good text as an expression over the votes."""
        odds = F.lit(math.log((1 - self.bad) / self.bad))
        for vote, g, b in zip(votes, self.on_good, self.on_bad, strict=True):
            odds = odds + (F.when(vote == 1, math.log(g[1] / b[1])).when(vote == -1, math.log(g[-1] / b[-1]))
                           .otherwise(math.log(g[0] / b[0])))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _no_worse_than_chance(bad: float, on_good: list[dict], on_bad: list[dict]) -> tuple[list[dict], list[dict]]:
    """A rule whose votes would speak for the other side says nothing."""
    for g, b in zip(on_good, on_bad, strict=True):
        if b[-1] < g[-1] or g[1] < b[1]:
            both = {v: (1 - bad) * g[v] + bad * b[v] for v in g}
            g.update(both)
            b.update(both)
    return on_good, on_bad


def fit(counts: dict[tuple, int], rounds: int = ROUNDS, smoothing: float = SMOOTHING) -> VoteModel:
    """EM over counts of vote patterns; starts from "any vote against is bad"."""
    total = sum(counts.values())
    width = len(next(iter(counts), ()))
    good = {p: 0.02 if -1 in p else 0.98 for p in counts}
    for _ in range(rounds):
        mass = sum(n * good[p] for p, n in counts.items())
        tables = []
        for sign in (1, -1):
            rows = []
            for j in range(width):
                seen = dict.fromkeys((-1, 0, 1), smoothing)
                for p, n in counts.items():
                    seen[p[j]] += n * (good[p] if sign > 0 else 1 - good[p])
                whole = sum(seen.values())
                rows.append({v: x / whole for v, x in seen.items()})
            tables.append(rows)
        bad = (total - mass + smoothing) / (total + 2 * smoothing)
        model = VoteModel(bad, *_no_worse_than_chance(bad, *tables))
        good = {p: 1 / (1 + math.exp(-max(-700.0, min(700.0, model.log_odds(p))))) for p in counts}
    return model


def train(counted: DataFrame) -> VoteModel | None:
    """Fit on the votes of all rows that pass the base test; None without any."""
    votes = rules()
    patterns = counted.where(~F.col("base_failed")).groupBy(*[v.alias(k) for k, v in votes.items()]).count()
    counts = {tuple(r)[:-1]: r["count"] for r in patterns.collect()}  # at most 3 ** 8 rows
    return fit(counts) if counts else None


def judge(counted: DataFrame, model: VoteModel | None, keep_at: float = KEEP_AT) -> DataFrame:
    """Adds quality_posterior and kept to rows that ``with_features`` made."""
    posterior = F.lit(None).cast("double") if model is None else model.posterior(list(rules().values()))
    return (counted.withColumn("quality_posterior", posterior)
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("quality_posterior") >= keep_at, F.lit(False))))


def _pattern() -> Column:
    """The votes as one number, a base-3 digit per rule."""
    return sum(((vote + 1) * 3**i for i, vote in enumerate(rules().values())), F.lit(0)).cast("int")


def _digits(pattern: str) -> list[Column]:
    return [F.floor(F.col(pattern) / 3**i).cast("int") % 3 - 1 for i in range(len(rules()))]


def kept_documents(docs: DataFrame, keep_at: float = KEEP_AT) -> DataFrame:
    """The rows of ``docs`` that the rules accept, with all their columns.

    Texts are counted once: rows that pass the base test are written with their
    votes, the model is fitted on these and picks among the rows. ``held`` of
    the result lists the scratch table that it reads.
    """
    whole = docs.select(F.struct("*").alias("row"), "text")
    passing = materialize(with_features(whole).where(~F.col("base_failed")).select("row", _pattern().alias("votes")),
                          "quality-candidates", compression="zstd")
    patterns = passing.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).select(*[d.alias(f"v{i}") for i, d in enumerate(_digits("votes"))], "n")
    counts = {tuple(r)[:-1]: r["n"] for r in patterns.collect()}  # at most 3 ** 8 rows
    accepted = fit(counts).posterior(_digits("votes")) >= keep_at if counts else F.lit(False)
    out = passing.where(accepted).select("row.*")
    out.held = [passing]
    return out


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = materialize(with_features(docs).drop("text"), "quality")
    return judge(counted, train(counted)).select("doc_id", *BASE, "base_failed", "kept", "quality_posterior")

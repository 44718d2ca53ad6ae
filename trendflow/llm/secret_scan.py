"""Scan for secrets: wide candidates, a random forest against false alarms.

A candidate is a PEM private key, a run of 16 or more characters of
``A-Za-z0-9+/_-`` with a letter or digit in it, or a value of any length and any
characters that a credential's name is given (quoted, or up to a space), that
follows a scheme of authorization, or that is the password in a URL. One may
lie in another; both are scored, and ``redact`` masks their union. Its features are its length, how its
characters change kind, how usual its letter pairs are, how much of it
dictionary words cover, marks of the path it was found in, and the words
beside it. A random forest of Spark ML decides, trained from labelled
findings: a seeded set of made-up secrets and usual false alarms
(``made_up_findings``) and all candidates of the corpus
whose surroundings tell their label: long values assigned to a credential's
name, and values behind "commit", "checksum" and the like. Those surroundings
are left out of their features, so they teach what such values look like. All
others stay unlabelled, and the corpus' rows never outweigh the made-up ones. The dictionary
is that of the commonest words of all documents, the pair counts are those of its words.

Cases: null and empty texts have no candidates; a null path has no marks.
Rows that repeat give their findings each. Null ids are kept. ``redact`` keeps
all rows and columns; texts without secrets stay as they are. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import discard, materialize, read_table, scratch_path, words

DICTIONARY = 5_000
#: Tasks that hold the training rows, a fixed number as the forest's draws depend on it.
TRAINING_TASKS = 12
TREES, DEPTH, SEED = 24, 8, 3
IS_SECRET = 0.5
MASK = "[SECRET]"

CANDIDATE = re.compile(
    r"(-----BEGIN [A-Z ]*PRIVATE KEY-----(?:.*?-----END [A-Z ]*PRIVATE KEY-----)?"
    r"|(?<![A-Za-z0-9+/_\-])(?=[+/_\-]*[A-Za-z0-9])[A-Za-z0-9+/_\-]{16,}={0,2})", re.S)
_NAME = r"(?:token|secret|pass(?:w(?:or)?d|phrase|code)|pwd|(?:api|access|private|account|secret|signing|encryption)[_-]?key|auth|bearer|credential)"
_VALUE = (r"(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)'|`([^`\n]+)`"
          r"|([^\s\"'`<>](?:(?![,;&]\s|[,;&][\w -]+=|[,;)\]}]+(?:\s|\Z)|\.(?:\s|\Z))[^\s\"'`<>])*))")
#: What a credential's name is given, quoted or not; what follows a scheme of
#: authorization; what stands between a user's name and the host of a URL.
GIVEN = (
    re.compile(rf"(?i){_NAME}[\w\-.]{{0,40}}(?:[\"']?\]?\s*(?:=>|:=|==?|:|>)\s*|(?<=\w)[\"']\s*,\s*(?=[\"'])|\s+(?=[\"']))"
               rf"(?:(?:basic|bearer|token)\s+)?{_VALUE}"),
    re.compile(rf"(?i)(?:--?{_NAME}[\w-]{{0,40}}|\bauthorization:?)\s+(?:(?:basic|bearer|token)\s+)?{_VALUE}"),
    re.compile(r"://[^\s/:@\"'<>]*:([^\s/\"'<>]+)@"),
)
NAMES = re.compile(r"(?i)(?:token|secret|pass(?:w(?:or)?d|phrase|code)|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|credential)")
ASSIGNED = re.compile(r"(?i)(?:token|secret|pass(?:w(?:or)?d|phrase|code)|pwd|key|auth|bearer|credentials?)(?:[_.-]\w{1,24})?[\"']?\s*(?:[:=]|=>)?\s*[\"']?$")
HARMLESS = re.compile(r"(?i)\b(?:commit|sha\d*|md5|uuid|guid|checksum|digest|hash|isbn|phone|card|order|integrity|example|id)\W*$")
PATH_MARKS = re.compile(r"(?i)(?:test|example|sample|fixture|mock|lock|docs?)\b")
VOID = re.compile(r"(?i)^(?:none|null|nil|true|false|str(?:ing)?|int|bool|required|optional|change_?me|your[_-].*|x+|\*+|\.+|<.*|[$%{].*|\[.*"
                  r"|[a-z_]+(?:\.[a-z_]+)*[\[(].*|(?:self|os|config|settings|process|env)\..*)$")
IN_URL = re.compile(r"://[^\s/:@\"'<>]*:?$")
KNOWN = re.compile(r"^(?:AKIA|ASIA|gh[pousr]_|sk[-_]|xox[abpr]-|AIza|eyJ|glpat-|-----BEGIN)")
AROUND = 48


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def features(value: str, before: str, after: str, path: str | None, dictionary: frozenset, pairs: dict) -> list[float]:
    kinds = [_kind(c) for c in value]
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, n - 1)
    letters = value.lower()
    seen = [pairs.get(letters[i:i + 2], -9.0) for i in range(n - 1) if letters[i:i + 2].isalpha()]
    covered = sum(len(w) for w in re.findall(r"[a-z]{3,}", letters) if w in dictionary)
    alphas = [c for c in letters if c.isalpha()]
    stuck = max(map(len, re.findall(r"[bcdfghjklmnpqrstvwxz]+", letters)), default=0)
    run, longest = 1, 1
    for a, b in zip(value, value[1:], strict=False):
        run = run + 1 if a == b else 1
        longest = max(longest, run)
    near = before.split()[-3:]
    return [
        float(min(n, 4096)), entropy, changes, *(kinds.count(k) / n for k in range(4)),
        sum(seen) / len(seen) if seen else -9.0, covered / n, float(longest),
        float(re.fullmatch(r"[0-9a-fA-F]+", value) is not None),
        float(re.fullmatch(r"[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}", letters) is not None),
        float(KNOWN.match(value) is not None), value.count("/") / n, value.count("-") / n,
        float(ASSIGNED.search(before) is not None), float(NAMES.search(" ".join(near)) is not None),
        float(HARMLESS.search(before) is not None), float(before[-1:] in "\"'="  and before != ""),
        float(after[:1] in "\"'" and after != ""), float(after[:1] == "." or before[-1:] == "."),
        float(after[:1] == "@"), float(PATH_MARKS.search(path or "") is not None),
        float(before[-1:].isalpha() or after[:1].isalpha()), float(IN_URL.search(before) is not None), float(VOID.match(value) is not None),
        sum(c in "aeiouyàáâäèéêëìíîïòóôöùúûü" for c in alphas) / len(alphas) if alphas else 0.0, float(min(stuck, 64)),
    ]


def spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of every candidate, once; one may lie in another."""
    return sorted({m.span(m.lastindex) for pattern in (CANDIDATE, *GIVEN) for m in pattern.finditer(text)})


def candidates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(key, text_hash, start, length, value, before, after, path) per candidate
    (start and length in code points)."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("text_hash"),
                       F.col(text).alias("text"), F.col(path).cast("string").alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512).to_pylist()
                found = [{"key": r["key"], "text_hash": r["text_hash"], "start": a, "length": b - a,
                          "value": r["text"][a:b], "before": r["text"][max(0, a - AROUND):a],
                          "after": r["text"][b:b + 8], "path": r["path"]}
                         for r in part if r["text"] for a, b in spans(r["text"])]
                if found:
                    yield pa.RecordBatch.from_pylist(found, schema=_FOUND)

    return rows.mapInArrow(run, "key long, text_hash long, start long, length long, value string, before string, "
                                "after string, path string")


_FOUND = pa.schema([("key", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("value", pa.string()), ("before", pa.string()), ("after", pa.string()), ("path", pa.string())])


def made_up_findings(seed: int = SEED, each: int = 120, vocabulary: tuple = ()) -> list[tuple]:
    """Labelled findings (value, before, after, path, label) from a seeded
    generator: credentials of public formats with and without a name before
    them, and what scanners trip over. ``vocabulary``: words of the corpus."""
    r = random.Random(seed)
    hexes, alnum = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    base64 = alnum + "+/"
    text = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    path = lambda: r.choice(["src/app.py", "config/settings.env", "src0", "notes.txt"])
    names = ["token", "secret", "password", "api_key", "access_key", "auth", "TOKEN", "Api-Key", "passphrase", "DB_PASSWORD", "client_secret"]
    usual = [*USUAL, *vocabulary]
    word = lambda: r.choice(usual)
    prose = lambda: r.choice(["", "use ", "see ", "with ", "is ", "\n", f"{word()} ", f"{word()} {word()} ", f"{word()}, ", f"{word()}. ", "(", "`"])
    ends = lambda: r.choice([" ", ".", "", "\n", ",", ")", "`", f" {word()}"])
    out = []
    for _ in range(each):
        name, quote = r.choice(names), r.choice(['"', "'", ""])
        sign = r.choice([" = ", "=", ": ", ":"])
        given, ended = f"{r.choice(['the ', '', 'export ', word() + ' '])}{name}{sign}{quote}", quote + r.choice([" and", "", "\n", ";"])
        random_value = r.choice([text(hexes, 40), text(hexes, 32).upper(), text(alnum, r.randint(20, 64)), text(base64, 40)])
        out.append((random_value, given, ended, path(), 1))
        # passwords and passphrases: short, with marks, or letters only
        chosen = r.choice([text(alnum + "!@#$%^&*.?-_", r.randint(6, 20)), f"{word()}{r.randint(0, 9999)}{r.choice('!@#$%&*')}",
                           text(alnum[:52], r.randint(8, 40)), "-".join(word() for _ in range(r.randint(3, 5))),
                           " ".join(word() for _ in range(4)), f"{word().title()}{r.choice('!@#$%.')}{word()}{r.randint(0, 99)}"])
        out.append((chosen, given, ended, path(), 1))
        known = r.choice(["AKIA" + text(alnum[:26] + "234567", 16), "ghp_" + text(alnum, 36), "sk-" + text(alnum, 40),
                          "xoxb-" + text("0123456789", 12) + "-" + text(alnum, 24), "AIza" + text(alnum, 35), "glpat-" + text(alnum, 20),
                          "eyJ" + text(alnum + "-_", 60)])
        out.append((known, r.choice([prose(), prose(), f"{name} ", "commit ", "id "]), ends(), path(), 1))
        # a token, or a password after a user's name, in a URL
        host = f"https://{word()}.example.com/"
        out.append(r.choice([(text(alnum, r.randint(20, 40)), f"{host}?{r.choice(['token', 'access_token', 'sig', 'api_key', 'k'])}=", r.choice([" ", "&"])),
                             (text(alnum, r.randint(20, 40)), "https://", "@example.com")]) + (path(), 1))
        out.append((r.choice([chosen.replace(" ", "_"), text(alnum, r.randint(6, 30)), word() + str(r.randint(0, 999))]),
                    f"{r.choice(['postgres', 'mysql', 'amqp', 'https', 'mongodb+srv'])}://{word()}:", f"@{word()}.ex", path(), 1))
        out.append((text(base64, r.choice([12, 16, 20, 24, 32, 40])) + r.choice(["", "=", "=="]),
                    f"{r.choice(['', 'curl -H '])}Authorization: {r.choice(['Basic', 'Bearer', 'basic'])} ", r.choice(["", "\n", '"', " "]), path(), 1))
        out.append((text(alnum, r.randint(24, 64)), prose(), ends(), path(), 1))
        kind = r.choice(["", "RSA ", "EC ", "OPENSSH ", "ENCRYPTED "])
        body = "\n".join(text(base64, 64) for _ in range(r.randint(2, 24)))
        out.append((f"-----BEGIN {kind}PRIVATE KEY-----" + r.choice([f"\n{body}\n-----END {kind}PRIVATE KEY-----", ""]),
                    r.choice([prose(), "commit ", "key id "]), ends(), path(), 1))
        h = text(hexes, 32)
        out.append((f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", r.choice(["id: ", "uuid ", "order ", prose()]), " of", path(), 0))
        out.append((text(hexes, r.choice([32, 40, 64])), r.choice(["commit ", "sha1 ", "checksum: ", "digest=", "md5: ", "hash "]), " from", path(), 0))
        out.append((text("0123456789", r.randint(16, 19)), r.choice(["card ", "phone ", "the ", "and ", prose()]), " is", path(), 0))
        long = "".join(r.choice(["the", "ing", "and", "tion", "er", "re", "on"]) for _ in range(r.randint(6, 9)))
        out.append((f"{long}{r.choice(['', str(r.randint(0, 99))])}", r.choice(["of ", "the ", "in "]), " to", path(), 0))
        out.append((f"usr/lib/{long[:9]}/{r.randint(1, 9)}/{long[:5]}", "in /", r.choice([".so", ".py", " "]), path(), 0))
        # names, paths and long words of the corpus
        several = [word() for _ in range(r.randint(3, 6))]
        joined = r.choice(["_", "-", "/", ""]).join(several)
        out.append((r.choice([joined, joined.upper(), "".join(x.title() for x in several)]) + r.choice(["", "", str(r.randint(0, 99))]),
                    prose(), ends(), path(), 0))
        # parts of words that hold letters with accents
        part = r.choice(["".join(several), long])[:r.randint(16, 30)]
        mark = r.choice("éàçñöüßø")
        lead, close = r.choice([(word()[:4] + mark, ends()), (prose(), mark + word()[-3:]), (mark, mark)])
        out.append((part, lead, close, path(), 0) if r.random() < 0.5 else (part.upper(), lead.upper(), close.upper(), path(), 0))
        out.append((r.choice(["x", "0", "1"]) * 16 + "0123456789"[: r.randint(1, 10)], f"{name}{sign}{quote}", f"{quote} e", "tests/fixture", 0))
        # a credential's name is given no value of its own
        void = r.choice(["None", "null", "str", "true", "false", "required", "${PASSWORD}", "<password>", "****", "xxxxxxxx", "{{ secret }}", "%s",
                         "$TOKEN", "os.environ[", "getpass()", "config.password", "self.token", "changeme", "your_token_here"])
        out.append((void, given, ended, path(), 0))
    return out


#: Words of any English text, for corpora too small to tell their own.
USUAL = tuple("""about after again always because before between change country different earth enough every example family father first
follow found great group house important large letter light little mother mountain number often people picture place point river school
second sentence should small something sound spell still story study their there these thing think though thought three through together
under until water which while white world would write young mountains internet information understanding international""".split())


class Scanner:
    """A trained forest with the dictionary and pair statistics it reads."""

    def __init__(self, model, dictionary: frozenset, pairs: dict):
        self.model, self.dictionary, self.pairs = model, dictionary, pairs

    def score(self, found: DataFrame) -> DataFrame:
        """Adds ``probability`` to rows with value, before, after and path."""
        scored = self.model.transform(_vectors(found, self.dictionary, self.pairs))
        return scored.withColumn("probability", vector_to_array("probability")[1]).drop("x", "rawPrediction", "prediction")


def _vectors(found: DataFrame, dictionary: frozenset, pairs: dict) -> DataFrame:
    """Adds the feature vector ``x``."""
    @F.udf("array<double>", useArrow=True)
    def row(value, before, after, path):
        return features(value, before, after, path, dictionary, pairs)

    return found.withColumn("x", array_to_vector(row("value", "before", "after", "path")))


def _language(docs: DataFrame, text: str, size: int) -> tuple[frozenset, dict]:
    """The ``size`` commonest words of all documents, and log shares of their
    letter pairs."""
    # written first: collected at once, every task would send the driver ``size`` words
    common = materialize(docs.select(F.explode(words(F.lower(text))).alias("w"))
                         .select(F.regexp_extract("w", r"^[^\p{L}]*(\p{L}{3,})", 1).alias("w")).where(F.col("w") != "")
                         .groupBy("w").count().orderBy(F.desc("count"), "w").limit(size), "words")
    counted = common.orderBy(F.desc("count"), "w").collect()
    discard(common)
    total: Counter = Counter(w[i:i + 2] for w in USUAL for i in range(len(w) - 1))
    for r in counted:
        for i in range(len(r["w"]) - 1):
            total[r["w"][i:i + 2]] += r["count"]
    whole = sum(total.values()) or 1
    return frozenset(r["w"] for r in counted), {p: math.log(n / whole) for p, n in total.items()}


def train(docs: DataFrame, found: DataFrame, *, text: str = "text") -> Scanner:
    """Fit on made-up findings and on all rows of ``found`` that have a label."""
    spark = docs.sparkSession
    dictionary, pairs = _language(docs, text, DICTIONARY)
    made = made_up_findings(vocabulary=tuple(sorted(dictionary)))
    value, before = F.col("value"), F.col("before")
    # no name before a value says nothing about it: such rows stay without a label
    label = (F.when(value.rlike(KNOWN.pattern), F.lit(None).cast("int")).when(before.rlike(HARMLESS.pattern), 0)
             .when(before.rlike(ASSIGNED.pattern) & value.rlike(r"^(?=.*[0-9])[A-Za-z0-9+/_\-]{16,}={0,2}$"), 1))
    # what is around a value of the corpus labels it and so must not be a feature of it:
    # these rows teach what such values look like, the made-up ones what names mean.
    # A value that comes often is one row with the weight of all
    none = F.lit("")
    labelled = materialize(found.select("value", label.alias("label")).where(F.col("label").isNotNull()).groupBy("value", "label")
                           .agg(F.count(F.lit(1)).alias("n")), "labelled")
    # the corpus' rows of a label weigh at most as much as the made-up ones
    many = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    weigh = {k: min(1.0, sum(m[4] == k for m in made) / many.get(k, 1)) for k in (0, 1)}
    own = labelled.select("value", none.alias("before"), none.alias("after"), F.lit(None).cast("string").alias("path"), "label",
                          (F.col("n") * F.when(F.col("label") == 1, weigh[1]).otherwise(weigh[0])).alias("weight"))
    rows = (spark.createDataFrame(made, "value string, before string, after string, path string, label int").withColumn("weight", F.lit(1.0))
            .unionByName(own)
            .withColumn("label", F.col("label").cast("double")))
    # the forest's draws depend on the partitions and on the order of rows in them
    dealt = rows.repartition(TRAINING_TASKS, "value").sortWithinPartitions("value", "before", "after", "path", "label")
    ready = _vectors(dealt, dictionary, pairs).select("x", "label", "weight").persist()
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    # a fitted model keeps its training summary, and with it the session, which tasks
    # cannot take; the stored one does not, and outlives this driver
    path = scratch_path(spark, "forest")
    forest.fit(ready).save(path)
    ready.unpersist()
    discard(labelled)
    return Scanner(RandomForestClassificationModel.load(path), dictionary, pairs)


def findings(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "source",
             is_secret: float = IS_SECRET) -> DataFrame:
    """All candidates with ``probability`` and ``secret`` (boolean)."""
    found = materialize(candidates(docs, key=key, text=text, path=path), "candidates")
    return train(docs, found, text=text).score(found).withColumn("secret", F.col("probability") >= is_secret)


def redact(docs: DataFrame, *, key: str = "doc_id", text: str = "text", path: str = "source", mask: str = MASK) -> DataFrame:
    """``docs`` with every secret replaced by ``mask``; n_chars, where there is
    one, follows the text. All rows and columns stay."""
    spans = (findings(docs, key=key, text=text, path=path).where("secret")
             .select("key", "text_hash", F.struct("start", "length").alias("span")).distinct()
             .groupBy("key", "text_hash").agg(F.array_sort(F.collect_list("span")).alias("spans")))
    whole = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("doc"), F.xxhash64(text).alias("h"))
    joined = whole.join(spans, whole["doc"].eqNullSafe(spans["key"]) & (whole["h"] == spans["text_hash"]), "left")
    old = F.col(f"row.{text}")
    # a span that begins before the last one's end only moves the end
    parts = F.aggregate("spans", F.struct(F.lit("").alias("s"), F.lit(1).cast("long").alias("at")), lambda acc, x: F.struct(
        F.when(x["start"] + 1 < acc["at"], acc["s"]).otherwise(
            F.concat(acc["s"], F.substring(old, acc["at"], x["start"] + 1 - acc["at"]), F.lit(mask))).alias("s"),
        F.greatest(acc["at"], x["start"] + x["length"] + 1).alias("at")), lambda acc: F.concat(acc["s"], F.substring(old, acc["at"], F.char_length(old))))
    new = F.when(F.col("spans").isNull(), old).otherwise(parts)
    columns = []
    for c in docs.columns:
        if c == text:
            columns.append(new.alias(c))
        elif c == "n_chars":
            columns.append(F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.char_length(new)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return joined.select(*columns)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return findings(docs).select(
        F.col("key").alias("doc_id"), "start", "length", F.sha2("value", 256).alias("value_sha256"), "probability", "secret")

"""Chat formatting from an event log.

The log has one row per event: conv_id, turn, tie, seq, kind, role, text.
``message`` opens a turn, ``delta`` appends to it, ``edit`` replaces its text,
``regenerate`` empties it and discards every later turn logged before. The
final messages are folded per turn and ordered by range, so a long
conversation (or a turn that many rows share) spreads over tasks: each task
numbers its slice, and a table of at most one row per slice carries the numbers
on. Only ``digests`` reads a conversation's text in one task, as a hash needs.

A turn is rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>``. Inside
roles and texts a backslash is doubled and every control string (these marks
and those of other templates) gets a backslash after its first character; a
reader undoes both from left to right, so any text survives.

Cases: null role and null text are empty; a null conversation id or turn is a
value of its own that sorts first; turns that tie are ordered by tie; deltas
of a turn never opened open it with an empty role; repeated events count each
time (equal seq: by text). Other columns are ignored; an empty log gives an
empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trendflow.llm.common import read_table, scratch_path

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Control strings of this template and of other public ones.
CONTROL = (START, SEP, END, "<|system|>", "<|user|>", "<|assistant|>", "<|endoftext|>", "<|end|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<start_of_turn>", "<end_of_turn>")
LEARNT = "assistant"
DELTA_CHARS = 512


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, tie, role, text): the final messages."""
    opens = F.col("kind").isin("message", "edit", "regenerate")
    per_turn = events.groupBy("conv_id", "turn", "tie").agg(
        F.max(F.when(opens, F.col("seq"))).alias("open"), F.max("seq").alias("last"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("again"))
    alive = (in_order(per_turn.withColumn("size", F.lit(0).cast("long")), ["conv_id"], ["turn", "tie"], "chat-turns", peak="again")
             .withColumnRenamed("peak", "cut").where(F.col("cut").isNull() | (F.col("last") > F.col("cut")))
             .select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("tie").alias("i"),
                     F.greatest(F.coalesce("open", F.lit(-(2**62))), F.coalesce("cut", F.lit(-(2**62)))).alias("since")))
    kept = (events.join(alive, events["conv_id"].eqNullSafe(alive["c"]) & events["turn"].eqNullSafe(alive["t"])
                        & events["tie"].eqNullSafe(alive["i"]))
            .where((F.col("seq") >= F.col("since")) | (F.col("kind") == "message")))
    piece = F.when(F.col("seq") >= F.col("since"), F.coalesce("text", F.lit(""))).otherwise("")
    return (kept.groupBy("conv_id", "turn", "tie").agg(
        F.max_by("role", F.when(F.col("kind") == "message", F.col("seq"))).alias("role"),
        F.array_sort(F.collect_list(F.struct("seq", piece.alias("text")))).alias("pieces"))
        .select("conv_id", "turn", "tie", F.coalesce("role", F.lit("")).alias("role"),
                F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("text")))


def render(messages: DataFrame) -> DataFrame:
    """One row per turn in order: conv_id, position, offset (code points before
    it in the conversation), rendered, loss_start and loss_end (both null for
    turns that are not learnt). The rows of a conversation lie in order over the
    partitions; read by position they are its formatted text."""
    header = F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP))
    rows = messages.select(
        "conv_id", "turn", "tie", F.char_length(header).cast("long").alias("head"),
        F.concat(header, escape(F.col("text")), F.lit(END)).alias("rendered"), (F.col("role") == LEARNT).alias("learnt"))
    rows = in_order(rows.withColumn("size", F.char_length("rendered").cast("long")), ["conv_id"], ["turn", "tie"], "rendered")
    return rows.select("conv_id", "position", "offset", "rendered",
                       F.when(F.col("learnt"), F.col("offset") + F.col("head")).alias("loss_start"),
                       F.when(F.col("learnt"), F.col("offset") + F.col("size") - len(END)).alias("loss_end"))


def in_order(rows: DataFrame, group: list[str], order: list[str], name: str, peak: str | None = None) -> DataFrame:
    """Adds ``position`` and ``offset`` (rows, and sum of ``size``, before a row
    of its group), and ``peak`` (the largest value of a long column before it,
    null without one), without putting a group into one task. The slices are
    written to scratch, so that all reads see the same ones."""
    spark = rows.sparkSession
    keys = [*group, *order]
    sliced = (rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
              .sortWithinPartitions(*keys).withColumn("slice", F.spark_partition_id()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, position, at, top = _NONE, 0, 0, None
        for batch in batches:
            positions, offsets, peaks = [], [], []
            values = batch.column(peak).to_pylist() if peak else [None] * batch.num_rows
            for key, size, value in zip(zip(*(batch.column(g).to_pylist() for g in group), strict=True),
                                        batch.column("size").to_pylist(), values, strict=True):
                if key != now:
                    now, position, at, top = key, 0, 0, None
                positions.append(position)
                offsets.append(at)
                peaks.append(top)
                position, at = position + 1, at + size
                top = value if top is None else top if value is None else max(top, value)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, pa.int64()) for v in (positions, offsets, peaks))],
                                             names=[*batch.schema.names, "position", "offset", "peak"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sliced.schema.fields)
    path = scratch_path(spark, name)
    local = sliced.mapInArrow(run, f"{fields}, position long, offset long, peak long")
    local.write.option("compression", "zstd").parquet(path)
    local = spark.read.schema(local.schema).parquet(path)
    # only the first group of a slice can have rows in an earlier one
    before = Window.partitionBy(*group).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    highest = F.max(peak) if peak else F.max(F.lit(None).cast("long"))
    carried = (local.groupBy("slice", *group).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("chars"), highest.alias("top"))
               .select(F.col("slice").alias("s"), *[F.col(g).alias(f"g_{g}") for g in group],
                       F.sum("n").over(before).alias("n_before"), F.sum("chars").over(before).alias("chars_before"),
                       F.max("top").over(before).alias("peak_before"))
               .where(F.col("n_before").isNotNull()))
    same = F.col("slice") == F.col("s")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"g_{g}"))
    return (local.join(F.broadcast(carried), same, "left")
            .withColumn("position", F.col("position") + F.coalesce("n_before", F.lit(0)))
            .withColumn("offset", F.col("offset") + F.coalesce("chars_before", F.lit(0)))
            .withColumn("peak", F.greatest("peak", "peak_before"))
            .select(*rows.columns, "position", "offset", *(["peak"] if peak else [])))


_NONE = object()
_TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns in a formatted text."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


class _Digest:
    """What a reader of one conversation's output adds up, turn by turn."""

    def __init__(self):
        self.turns, self.chars, self.learnt = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, row: dict) -> None:
        for role, text in parse(row["rendered"]):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.chars += len(row["rendered"])
        if row["loss_start"] is not None:
            text = unescape(row["rendered"][row["loss_start"] - row["offset"]:row["loss_end"] - row["offset"]])
            self.learnt += len(text)
            self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self, conv_id) -> dict:
        return {"conv_id": conv_id, "n_turns": self.turns, "turns_sha256": self.all.hexdigest(), "loss_chars": self.learnt,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}


_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def digests(rendered: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``render``'s rows in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = _NONE, _Digest()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["conv_id"] != now:
                    if now is not _NONE:
                        out.append(digest.row(now))
                    now, digest = r["conv_id"], _Digest()
                digest.read(r)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=_DIGEST)
        if now is not _NONE:
            yield pa.RecordBatch.from_pylist([digest.row(now)], schema=_DIGEST)

    ordered = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                                    "formatted_chars long")


def log_of(rows: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The log of a stream that delivered these rows (conv_id, turn, role,
    text): each row is a message followed by deltas of its text. Rows that
    share a turn are ordered by role and text."""
    numbered = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                           "role", "text", F.lit(0).cast("long").alias("size"))
    numbered = in_order(numbered, ["conv_id", "turn"], ["role", "text"], "chat-log").withColumn("tie", F.col("position"))
    parts = F.ceil(F.char_length(F.coalesce("text", F.lit(""))) / delta_chars).cast("int")
    events = numbered.withColumn("part", F.explode(F.sequence(F.lit(0), parts)))
    return events.select(
        "conv_id", "turn", "tie", F.col("part").cast("long").alias("seq"),
        F.when(F.col("part") == 0, "message").otherwise("delta").alias("kind"), "role",
        F.when(F.col("part") == 0, "").otherwise(
            F.substring("text", (F.col("part") - 1) * delta_chars + 1, F.lit(delta_chars))).alias("text"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -7L conv_id, t turn, r role, '{odd}' text FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    return digests(render(fold(log_of(rows.unionByName(extra)))))

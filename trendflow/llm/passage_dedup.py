"""Removal of passages that repeat an earlier one, byte for byte.

Every byte is removed that a string of ``LENGTH`` bytes covers which also
starts earlier (in a document of smaller id, or further ahead in the same one).
Which strings are equal is found by merging Burrows-Wheeler transforms
(``bwt_merge``); the steps around it deal a corpus into cells of bounded size
such that equal strings always meet.

1. Anchors. Of the ``LENGTH - GRAM + 1`` grams of a window the one of smallest
   hash is its anchor, so equal windows have equal anchors at equal places.
   Runs of windows with one anchor are written as small rows without text.
2. Anchors that occur once are dropped: rows are range-partitioned by anchor
   and compared with their neighbours; at the borders of partitions they stay.
3. Segments. A document's remaining runs are cut from its text (windows of one
   anchor, about 130 bytes). Equal segments that one task sees become one, the
   first; the others repeat it whole.
4. An anchor of more than ``HOT`` segments is split: equal segments become one
   over all tasks (again by range and neighbours, which spreads one anchor over
   many tasks), and what is left is dealt by longer common strings: windows in
   which the anchor lies further back share more bytes behind it, and vice
   versa. Halving the places down to one window ends this.
5. Cells. Anchors are dealt by hash over cells of about ``CELL_BYTES``. A cell
   makes a Burrows-Wheeler transform per shard of its segments, merges the
   transforms by iterative interleave refinement and returns the repeated
   windows, each but the first of its interval.
6. The spans meet their documents, and the bytes outside them stay.

Order of rows: by id, then by a hash of the text; null ids come last. Rows of
equal id and equal text are one document that is listed repeatedly: they get
equal results, and none repeats the other.

Cases: a null text counts as empty; texts shorter than ``LENGTH`` stay whole.
Windows never cross documents. Other input columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm import bwt_merge
from trendflow.llm.common import discard, materialize, read_table

LENGTH = 100
GRAM = 40
HOT = 4096
CELL_BYTES = 4 << 20
SHARDS = 4
#: Bytes of text that are hashed at a time, and what a task holds at most: bytes
#: of segments that it compares among themselves, and spans found so far.
CHUNK = 1 << 18
REMEMBERED = 64 << 20
SPANS = 200_000
#: Anchors are compared by hash, then by place, which takes the low bits.
PLACE = np.uint64((1 << 31) - 1)

_SPOT = "key long, doc long, sub long, at long"
_SEGMENT = "key long, seg binary, a int, low int, high int, doc long, sub long, start long, n long"
_SPAN = "doc long, sub long, start long, n long"


def grams(x: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes from each place on, doubled up from bytes."""
    h = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    by_width, width = {1: h}, 1
    while 2 * width <= gram:
        left = by_width[width][:-width] * np.uint64(0xBF58476D1CE4E5B9)
        left ^= left >> np.uint64(29)
        left += by_width[width][width:]
        width *= 2
        by_width[width] = left
    out, done = by_width[width], width
    while done < gram:
        width = max(w for w in by_width if w <= gram - done)
        more = by_width[width][done:]
        n = min(len(out), len(more))
        out = out[:n] * np.uint64(0x94D049BB133111EB)
        out ^= out >> np.uint64(31)
        out += more[:n]
        done += width
    out = out[:len(x) - gram + 1] * np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def anchors(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, first, n, a) per run of windows with one anchor in the texts
    ``x[starts:ends]``: hash, first window, number of windows, and the anchor's
    place behind the first window's start."""
    h = grams(x, gram)
    low = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    many, width = length - gram + 1, 1
    while 2 * width <= many:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < many:
        low = np.minimum(low[:-(many - width)], low[many - width:])
    place = (low & PLACE).astype(np.int64)
    long_enough = ends - starts >= length
    edge = np.zeros(len(x) + 1, dtype=np.int32)
    np.add.at(edge, starts[long_enough], 1)
    np.add.at(edge, ends[long_enough] - length + 1, -1)
    window = np.flatnonzero(np.cumsum(edge[:len(place)]))
    place = place[window]
    run = np.flatnonzero(np.concatenate([np.ones(min(1, len(place)), dtype=bool), place[1:] != place[:-1]]))
    first, place, n = window[run], place[run], np.diff(np.append(run, len(window)))
    return h[place].astype(np.int64), first, n, place - first


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts or bytes without nulls, and the bounds."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    at = np.frombuffer(bounds, dtype=kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8), at


def _find_anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _texts(batch.column("text"))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, side="right")) - 1)
                x, starts, ends = data[at[i]:at[j]], at[i:j] - at[i], at[i + 1:j + 1] - at[i]
                key, first, n, a = anchors(x, starts, ends, length, gram) if len(x) >= length else [np.zeros(0, dtype=np.int64)] * 4
                row = np.searchsorted(starts, first, side="right") - 1
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), batch.column("doc").take(rows), batch.column("sub").take(rows),
                     pa.array((first - starts[row]) << 16 | n << 8 | a)], names=["key", "doc", "sub", "at"])
                i = j

    return run


def _with_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition whose key a neighbour has, and its first and
    last row, whose neighbours may lie in other partitions."""
    held, same = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        key = batch.column("key").to_numpy()
        equal = key[1:] == key[:-1]
        keep = np.concatenate([[same], equal[:-1]]) | equal if len(key) > 1 else np.zeros(0, dtype=bool)
        yield batch.slice(0, len(keep)).filter(pa.array(keep))
        held, same = batch.slice(len(keep)), bool(equal[-1]) if len(key) > 1 else same
    if held is not None:
        yield held


class _Seen:
    """Segments by content: the first occurrence of each, and spans of others."""

    def __init__(self):
        self.rows, self.spans, self.bytes, self.found = {}, {}, 0, 0

    def add(self, seg: bytes, key: int, place: tuple, n: int, a: int, low: int, high: int) -> None:
        """``place``: (id or the largest number, sub, start, id or None)."""
        old = self.rows.get((key, seg))
        if old is None:
            self.rows[key, seg] = (place, n, a, low, high)
            self.bytes += len(seg)
        elif place[:3] != old[0][:3]:
            if place[:3] < old[0][:3]:
                self.rows[key, seg], place, n = (place, n, a, low, high), old[0], old[1]
            self.spans.setdefault((place[3], place[1]), []).append((place[2], n))
            self.found += 1

    def bounded(self, most: int) -> Iterator[pa.RecordBatch]:
        """What has to leave so that no more than ``most`` bytes of segments and
        ``SPANS`` spans are held."""
        if self.bytes > most:
            yield from self.take()
        elif self.found > SPANS:
            yield from _spans(self.spans)
            self.spans, self.found = {}, 0

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            keys, values = zip(*self.rows.items(), strict=True)
            place, n, a, low, high = zip(*values, strict=True)
            yield _segments([k for k, _ in keys], [s for _, s in keys], a, low, high,
                            [p[3] for p in place], [p[1] for p in place], [p[2] for p in place], n)
        yield from _spans(self.spans)
        self.__init__()


def _segments(key, seg, a, low, high, doc, sub, start, n) -> pa.RecordBatch:
    i64, i32 = pa.int64(), pa.int32()
    return pa.RecordBatch.from_arrays(
        [pa.array(key, i64), pa.array(seg, pa.binary()), pa.array(a, i32), pa.array(low, i32), pa.array(high, i32),
         pa.array(doc, i64), pa.array(sub, i64), pa.array(start, i64), pa.array(n, i64)],
        names=["key", "seg", "a", "low", "high", "doc", "sub", "start", "n"])


def _spans(found: dict) -> Iterator[pa.RecordBatch]:
    """Rows without a segment: n windows from ``start`` on repeat earlier ones.
    Runs of a document that meet become one."""
    rows = []
    for (doc, sub), runs in found.items():
        at = end = None
        for start, n in sorted(runs):
            if end is not None and start <= end:
                end = max(end, start + n)
                continue
            if end is not None:
                rows.append((doc, sub, at, end - at))
            at, end = start, start + n
        rows.append((doc, sub, at, end - at))
    if rows:
        none = [None] * len(rows)
        yield _segments(none, none, none, none, none, *map(list, zip(*rows, strict=True)))


def _order(doc: int | None) -> int:
    return (1 << 63) - 1 if doc is None else doc


def _cut(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for batch in batches:
            data, at = _texts(batch.column("text"))
            docs, subs = batch.column("doc").to_pylist(), batch.column("sub").to_pylist()
            spots = batch.column("spots")
            bounds = spots.offsets.to_numpy()
            spot = spots.values  # its own offset is part of the bounds
            key, packed = (spot.field(i).to_numpy().tolist() for i in (0, 1))
            for i, (doc, sub) in enumerate(zip(docs, subs, strict=True)):
                text = data[at[i]:at[i + 1]].tobytes()
                for j in range(bounds[i], bounds[i + 1]):
                    start, n, a = packed[j] >> 16, packed[j] >> 8 & 255, packed[j] & 255
                    seen.add(text[start:start + n + length - 1], key[j], (_order(doc), sub, start, doc), n, a, 0, length - gram)
                yield from seen.bounded(REMEMBERED)
        yield from seen.take()

    return run


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal segments that are neighbours in a sorted partition become one."""
    seen, last = _Seen(), None
    for batch in batches:
        for r in batch.to_pylist():
            # the first of equal segments stays until the next one comes
            yield from seen.bounded(CELL_BYTES if last != (r["key"], r["seg"]) else 1 << 62)
            last = (r["key"], r["seg"])
            seen.add(r["seg"], r["key"], (_order(r["doc"]), r["sub"], r["start"], r["doc"]), r["n"], r["a"], r["low"], r["high"])
    yield from seen.take()


def _halve(length: int):
    """Deal the windows of a segment by the anchor's place in them, which is from
    ``low`` to ``high``, into two halves; all windows of a half share the bytes
    around the anchor that the new key is a hash of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                seg, a, n, middle = r["seg"], r["a"], r["n"], (r["low"] + r["high"]) // 2
                for low, high in ((r["low"], middle), (middle + 1, r["high"])):
                    first, end = a - min(high, a), a - max(low, a - n + 1) + 1
                    if first >= end:
                        continue
                    core = b"%d %d %d " % (r["key"], low, high) + seg[a - low:a - high + length]
                    key = int.from_bytes(hashlib.blake2b(core, digest_size=8).digest(), "little", signed=True)
                    out.append((key, seg[first:end + length - 1], a - first, low, high, r["doc"], r["sub"], r["start"] + first, end - first))
            if out:
                yield _segments(*map(list, zip(*out, strict=True)))

    return run


def _cells(length: int, shards: int):
    """Repeated windows of the cells of a partition sorted by cell."""

    def solve(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for r in rows:
            seen.add(r["seg"], r["key"], (_order(r["doc"]), r["sub"], r["start"], r["doc"]), r["n"], 0, 0, 0)
        per_key: dict = {}
        for key, seg in seen.rows:
            per_key.setdefault(key, []).append(seg)
        # a segment that is alone with its anchor has no equal windows
        segs = [(key, seg) for key, alike in per_key.items() if len(alike) > 1 for seg in alike]
        if segs:
            dealt = [segs[i::shards] for i in range(min(shards, len(segs)))]
            segs = [s for part in dealt for s in part]
            block, string, window = bwt_merge.merge(
                [bwt_merge.transform([seg for _, seg in part]) for part in dealt],
                [np.array([len(seg) - length + 1 for _, seg in part]) for part in dealt], length)
            place = [seen.rows[s][0] for s in segs]
            doc, sub, start = (np.array([p[i] for p in place], dtype=np.int64)[string] for i in range(3))
            start = start + window
            by = np.lexsort((start, sub, doc, block))
            block, string, doc, sub, start = block[by], string[by], doc[by], sub[by], start[by]
            at = np.arange(len(block))
            head = np.maximum.accumulate(np.where(np.concatenate([np.ones(min(1, len(at)), dtype=bool), block[1:] != block[:-1]]), at, 0))
            later = (doc != doc[head]) | (sub != sub[head]) | (start != start[head])
            for s, b in zip(string[later].tolist(), start[later].tolist(), strict=True):
                seen.spans.setdefault((place[s][3], place[s][1]), []).append((b, 1))
        yield from _spans(seen.spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["cell"] != cell:
                    yield from solve(rows)
                    cell, rows = r["cell"], []
                rows.append(r)
        yield from solve(rows)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.select(["doc", "sub", "start", "n"])

    return spans


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = _texts(batch.column("text"))
            runs = batch.column("runs").to_pylist()
            spans, kept = [], []
            for i, found in enumerate(runs):
                text = data[at[i]:at[i + 1]].tobytes()
                own, parts, end = [], [], 0
                for r in sorted(found or [], key=lambda r: r["start"]):
                    a, b = r["start"], r["start"] + r["n"] + length - 1
                    if own and a <= end:
                        own[-1]["length"] = max(end, b) - own[-1]["start"]
                    else:
                        parts.append(text[end:a])
                        own.append({"start": a, "length": b - a})
                    end = max(end, b)
                parts.append(text[end:])
                spans.append(own)
                kept.append(b"".join(parts))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(np.diff(at)), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc", "n_bytes", "spans", "kept"])

    return run


def repeated_windows(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                     cell_bytes: int = CELL_BYTES, shards: int = SHARDS) -> DataFrame:
    """(doc, sub, start, n): n windows from byte ``start`` on start earlier
    elsewhere. ``docs``: doc (long), sub (a hash of the text) and text, without
    null texts. Spans of one document may overlap. ``held`` lists the scratch
    tables that the result reads."""
    if not 0 < gram <= length or length - gram + 1 > 255:
        raise ValueError("a window holds one to 255 grams")
    # each step's shuffle files go with it, and what it read once the next is written
    spots = materialize(docs.where(F.octet_length("text") >= length).mapInArrow(_find_anchors(length, gram), _SPOT), "anchors")
    again = materialize(
        spots.repartitionByRange("key", "doc", "sub", "at").sortWithinPartitions("key").mapInArrow(_with_neighbours, _SPOT)
        .groupBy("doc", "sub").agg(F.collect_set(F.struct("key", "at")).alias("spots"))
        .withColumnsRenamed({"doc": "d", "sub": "s"}), "anchors-again")
    discard(spots)
    same = docs["doc"].eqNullSafe(again["d"]) & (docs["sub"] == again["s"])
    # segments that follow one another overlap, which this codec uses
    cut = materialize(docs.join(again, same).select("doc", "sub", "text", "spots").mapInArrow(_cut(length, gram), _SEGMENT),
                      "segments", compression="zstd")
    discard(again)
    held, whole, cells = [cut], [_only_spans(cut)], []
    rest = cut.where(F.col("key").isNotNull())
    while True:
        many = materialize(rest.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > hot).select("key"), "hot-anchors")
        held.append(many)
        if many.isEmpty():
            cells.append(rest)
            break
        cells.append(rest.join(many, "key", "left_anti"))
        once = materialize(rest.join(many, "key", "left_semi").repartitionByRange("key", "seg", "doc", "sub", "start")
                           .sortWithinPartitions("key", "seg").mapInArrow(_collapse, _SEGMENT), "hot-segments")
        held.append(once)
        whole.append(_only_spans(once))
        rest = once.where(F.col("key").isNotNull())
        still = materialize(rest.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.max(F.col("high") - F.col("low")).alias("wide"))
                            .where((F.col("many") > hot) & (F.col("wide") > 0)).select("key"), "hot-anchors")
        held.append(still)
        cells.append(rest.join(still, "key", "left_anti"))
        rest = materialize(rest.join(still, "key", "left_semi").mapInArrow(_halve(length), _SEGMENT), "halves")
        held.append(rest)
    rows = reduce(DataFrame.unionByName, cells)
    size = rows.agg(F.sum(F.octet_length("seg"))).first()[0] or 0
    cell = F.pmod(F.col("key"), F.lit(1 + size // cell_bytes)).alias("cell")
    found = (rows.select(cell, "key", "seg", "doc", "sub", "start", "n").repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(_cells(length, shards), _SPAN))
    out = materialize(reduce(DataFrame.unionByName, [*whole, found]), "spans")
    discard(*held)
    out.held = [out]
    return out


def _only_spans(table: DataFrame) -> DataFrame:
    return table.where(F.col("key").isNull()).select("doc", "sub", "start", "n")


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """(doc, n_bytes, spans, kept) per row of ``docs``: its id, the bytes of its
    text, the removed ones as maximal (start, length), and what stays (binary,
    as a span may begin or end inside a character)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(body).alias("sub"), body.alias("text"))
    spans = repeated_windows(rows, length, **options)
    per_doc = (spans.groupBy("doc", "sub").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
               .withColumnsRenamed({"doc": "d", "sub": "s"}))
    same = rows["doc"].eqNullSafe(per_doc["d"]) & (rows["sub"] == per_doc["s"])
    return (rows.join(per_doc, same, "left").select("doc", "text", "runs").mapInArrow(
        _remove(length), "doc long, n_bytes long, spans array<struct<start: long, length: long>>, kept binary"))


def op12_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read_table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["length"])
    return found.select(F.col("doc").alias("doc_id"), "n_bytes", removed.alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: By a table of all windows in hexadecimal digits; for ids that are not repeated.
PASSAGE_SQL = r"""WITH rows AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS b FROM documents),
d AS (SELECT DISTINCT doc_id, b FROM rows),
w AS (
  SELECT doc_id, i, substr(b, 2 * i + 1, 200) AS s
  FROM (SELECT doc_id, b, unnest(range(0, CAST(length(b) / 2 AS BIGINT) - 99)) AS i FROM d WHERE length(b) >= 200)),
r AS (SELECT doc_id, i FROM w QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM g),
p AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS e FROM n GROUP BY doc_id, span),
q AS (SELECT doc_id, a, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
k AS (
  SELECT q.doc_id, sum(e - a) AS n_removed, count(*) AS n_spans, max(e) AS last,
         string_agg(substr(b, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
  FROM q JOIN d ON q.doc_id = d.doc_id GROUP BY q.doc_id)
SELECT d.doc_id, CAST(length(b) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(b, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM rows d LEFT JOIN k ON d.doc_id = k.doc_id"""

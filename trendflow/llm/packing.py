"""Cost-balanced packing of documents into training sequences.

The cost of a piece of L tokens is estimated as L + QUADRATIC * L * L
(feed-forward work grows with the tokens, attention with their square).
Documents are tokenised once and cut at multiples of the sequence length; the
pieces are dealt over shards of bounded size by a hash of id and text. Inside
a shard as many sequences are opened as its tokens fill, and the pieces, in
descending order, go to the sequence of lowest cost that still has room for
the whole of them. What fits nowhere whole is cut to fill sequences with room,
so that all padding of a shard is less than one sequence.

A shard holds about SHARD_TOKENS tokens plus at most one longest document, so
a task's memory does not grow with the corpus, and padding stays below one
sequence in SHARD_TOKENS / 2048. Sequence ids are the shard's number in the
upper 32 bits and the sequence's within the shard in the lower ones: unique,
not consecutive.

Cases: a null or empty text is a document of the end token alone. Rows that
repeat an id are packed each on its own; equal rows share a shard and are
told apart by their order there. Null ids are packed like others. Other
input columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendflow.llm.common import read_table

LENGTH = 2048
END_ID = 1
QUADRATIC = 1 / 4096  # attention costs as much as the rest at 4,096 tokens
SHARD_TOKENS = 1 << 21
_TOKENIZERS: dict[str, "_Ids"] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Ids:
    """Ids of texts by a byte-level BPE vocabulary in tokenizers' JSON form.

    The same vocabulary as ranks, in tiktoken, gives the same ids at several
    times the speed (merges come in the order of their ids). A text that holds
    one of the vocabulary's added tokens goes through tokenizers itself.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        self.added = [t["content"] for t in vocabulary["added_tokens"]]
        letters = _byte_letters(set(ByteLevel.alphabet()))
        ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary["model"]["vocab"].items()
                 if token not in self.added}
        self.fast = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if any(token in text for token in self.added):
            ids = self.exact.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast(text)
        return array("I", ids).tobytes()


def _byte_letters(alphabet: set[str]) -> dict[str, int]:
    """Letter -> byte of byte-level vocabularies: printable Latin-1 stands for
    itself, the other bytes in order for the letters from 256 on."""
    own = {chr(b): b for b in range(256) if chr(b) in alphabet}
    rest = [b for b in range(256) if b not in own.values()]
    return own | {chr(256 + k): b for k, b in enumerate(rest)}


def _ids_of(path: str) -> _Ids:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = _Ids(path)
    return _TOKENIZERS[path]


def _tokenize(path: str, length: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _ids_of(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                keys, shards, starts, totals, ids = [], [], [], [], []
                rows = zip(part.column("doc_id").to_pylist(), part.column("shard").to_pylist(),
                           map(ids_of, part.column("text").to_pylist()), strict=True)
                for key, shard, raw in rows:
                    raw += end
                    total = len(raw) // 4
                    for start in range(0, total, length):
                        piece = raw[4 * start:4 * (start + length)]
                        keys.append(key)
                        shards.append(shard)
                        starts.append(start)
                        totals.append(total)
                        ids.append(_narrow(piece))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(shards, pa.int32()), pa.array(starts, pa.int64()),
                     pa.array(totals, pa.int64()), pa.array([len(x) >> 1 for x in ids], pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "shard", "start", "doc_tokens", "size", "ids"])

    return run


def _narrow(raw: bytes) -> bytes:
    """Ids as 16-bit numbers for the shuffle; the vocabularies at hand fit."""
    ids = np.frombuffer(raw, dtype="<u4")
    if len(ids) and ids.max() >= 1 << 16:
        raise ValueError("this vocabulary has ids beyond 16 bits")
    return ids.astype("<u2").tobytes()


def assign(sizes: list[int], length: int, quadratic: float = QUADRATIC) -> list[list[tuple[int, int, int, int]]]:
    """For each piece (descending sizes): its parts as (from, tokens, sequence,
    offset). A piece stays whole while some sequence has room for it."""
    n = max(1, -(-sum(sizes) // length))
    used = [0] * n
    heap = [(0.0, k) for k in range(n)]  # cost, sequence
    open_ = set(range(n))
    out = []
    for size in sizes:
        put_back, parts, done = [], [], 0
        while heap:
            cost, k = heapq.heappop(heap)
            if used[k] + size <= length:
                parts.append((0, size, k, used[k]))
                used[k] += size
                if used[k] < length:
                    heapq.heappush(heap, (cost + size + quadratic * size * size, k))
                else:
                    open_.discard(k)
                break
            put_back.append((cost, k))
        for item in put_back:
            heapq.heappush(heap, item)
        if not parts:
            # fullest first: closes sequences and leaves room in few
            for k in sorted(open_, key=lambda k: (used[k], -k), reverse=True):
                part = min(size - done, length - used[k])
                parts.append((done, part, k, used[k]))
                used[k] += part
                done += part
                if used[k] == length:
                    open_.discard(k)
                if done == size:
                    break
            heap = [(c, k) for c, k in heap if k in open_]
            heapq.heapify(heap)
        out.append(parts)
    return out


def _pack_shards(length: int, quadratic: float):
    def pack(shard: int, rows: list[tuple]) -> pa.RecordBatch:
        out = [[] for _ in range(8)]
        for (key, start, total, _, ids), parts in zip(rows, assign([r[3] for r in rows], length, quadratic), strict=True):
            for begin, size, k, offset in parts:
                piece = ids[2 * begin:2 * (begin + size)]
                wide = np.frombuffer(piece, dtype="<u2").astype("<u4")
                for column, value in zip(out, (key, start + begin, size, zlib.crc32(wide.tobytes()), total,
                                               (shard << 32) + k, offset, piece), strict=True):
                    column.append(value)
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=list(_PIECE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("shard", "doc_id", "start", "doc_tokens", "size", "ids")]
            for s, *row in zip(*cols, strict=True):
                if s != shard:
                    if rows:
                        yield pack(shard, rows)
                    shard, rows = s, []
                rows.append(row)
        if rows:
            yield pack(shard, rows)

    return run


_PIECE = {"doc_id": "long", "start": "long", "length": "long", "ids_crc32": "long", "doc_tokens": "long",
          "sequence_id": "long", "offset": "long", "ids": "binary"}


def pack(docs: DataFrame, vocabulary: str | None = None, length: int = LENGTH, end_id: int = END_ID,
         quadratic: float = QUADRATIC, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and the ids (little-endian 16-bit numbers)."""
    text = F.coalesce("text", F.lit(""))
    # about three bytes a token; every document adds its end token
    total = docs.agg(F.sum(F.octet_length(text) / 3 + 1).alias("n")).first()["n"] or 0
    shards = max(1, round(total / shard_tokens))
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                        F.pmod(F.xxhash64("doc_id", F.xxhash64(text)), F.lit(shards)).cast("int").alias("shard"))
    pieces = dealt.mapInArrow(_tokenize(vocabulary or default_vocabulary(), length, end_id),
                              "doc_id long, shard int, start long, doc_tokens long, size int, ids binary")
    ordered = pieces.repartition("shard").sortWithinPartitions("shard", F.desc("size"), "doc_id", "start", "ids")
    return ordered.mapInArrow(_pack_shards(length, quadratic), ", ".join(f"{k} {v}" for k, v in _PIECE.items()))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("ids")

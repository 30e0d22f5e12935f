"""Best-fit packing of documents into sequences of a fixed number of tokens.

A plan depends on piece lengths alone, so Spark counts the pieces of each length, the plan is
made for the counts (at most `capacity` of them, whatever the corpus), and each piece takes the
place that its rank among pieces of its length has in the plan. Pieces above a third of the
capacity are matched greedily, at most two to a sequence; smaller ones go, largest first, to the
smallest gap that holds them.

Defined cases: a missing or empty text is one piece with the end token alone; equal rows are
packed one by one; a text above the capacity is cut so that only its first piece is shorter; an
empty table has no sequences; columns other than `doc_id` and `text` are ignored.
"""

from __future__ import annotations

import json
import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbside.llm.common import slices, stored, texts

END = 0
CAPACITY = 2_048
# Subsets of one length that are ranked apart, so that a frequent length is not one task's work.
BUCKETS = 1_024


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _same_by_ranks(path: str):
    """The tokenizer's ordinary encoding by merge ranks, if its file defines no more than that.

    A byte-level vocabulary whose ids follow its merges gives the same ids by ranks, several
    times faster and in little memory. For any other file: None.
    """
    described = json.loads(Path(path).read_text(encoding="utf-8"))
    model, before = described["model"], described["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (
        described["normalizer"] is None and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space") and before.get("use_regex", True)
        and model.get("type") == "BPE" and not model.get("dropout")
        and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and [vocab.get(a + b) for a, b in merges] == list(range(256, 256 + len(merges)))
    )
    if not plain:
        return None
    # Byte-level files write the bytes that are no visible Latin-1 letters as 256, 257, ...
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items()
             if i < 256 + len(merges)}
    return tiktoken.Encoding(
        "ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


# FIXED VALUES: how byte-level tokenizer files split a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Encoder:
    """Ids of whole texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        tokenizer = Tokenizer.from_file(path)
        self.exact = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.ordinary = _same_by_ranks(path) or self.exact

    def encode(self, text: str) -> bytes:
        added = any(token in text for token in self.added)
        return _bytes(self.exact(text) if added else self.ordinary(text))


@lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    """One encoder for all tasks of a worker."""
    return _Encoder(path)


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every row's tokens cut to the capacity."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        end = np.array([END], dtype="<u4").tobytes()
        for batch in slices(batches):
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(map(encoder.encode, texts(batch))):
                ids += end
                n = len(ids) // 4
                at, number = 0, 0
                while at < n:
                    size = (n - at) % capacity or capacity
                    row.append(i)
                    piece.append(number)
                    start.append(at)
                    length.append(size)
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                    at, number = at + size, number + 1
            numbers = [pa.array(piece, pa.int32()),
                       *[pa.array(c, pa.int64()) for c in (start, length, crc)]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), *numbers],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Places for `counts[length]` pieces of each length, as rows of equal placements.

    A row (length, rank, count, each, sequence, offset): from that rank on, `count` pieces of the
    length go to sequences numbered from `sequence`, `each` to a sequence, side by side from
    `offset`. Sequences with the same content are planned together, so work and rows depend on
    the number of lengths, not of pieces.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used: Counter[int] = Counter()
    rows: list[tuple[int, ...]] = []
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens: (first sequence, how many)
    free: list[int] = []  # the keys of gaps, ascending

    def place(length: int, count: int, each: int, sequence: int, offset: int) -> None:
        rows.append((length, used[length], count, each, sequence, offset))
        used[length] += count
        left[length] -= count
        if not left[length]:
            del left[length]

    def leave(gap: int, sequence: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                insort(free, gap)
            gaps.setdefault(gap, []).append((sequence, count))

    def open_new(count: int) -> int:
        nonlocal opened
        opened += count
        return opened - count

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for a in large:
        while left.get(a):
            b = next((n for n in large if n <= capacity - a and left.get(n)
                      and (n != a or left[a] > 1)), 0)
            if not b:
                count = left[a]
                first = open_new(count)
                place(a, count, 1, first, 0)
                leave(capacity - a, first, count)
                break
            count = left[a] // 2 if a == b else min(left[a], left[b])
            first = open_new(count)
            place(a, count, 1, first, 0)
            place(b, count, 1, first, a)
            leave(capacity - a - b, first, count)
    for a in sorted(left, reverse=True):
        while left.get(a):
            spot = bisect_left(free, a)
            if spot == len(free):  # no gap holds it: open sequences, as many as they fill
                count = -(-left[a] // (capacity // a))
                leave(capacity, open_new(count), count)
                continue
            gap = free[spot]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                free.pop(spot)
            each = gap // a
            full = min(count, left[a] // each)
            if full:
                place(a, full * each, each, first, capacity - gap)
                leave(gap - each * a, first, full)
                leave(gap, first + full, count - full)
            else:  # the last pieces of this length share one sequence
                rest = left[a]
                place(a, rest, rest, first, capacity - gap)
                leave(gap - rest * a, first, 1)
                leave(gap, first + 1, count - 1)
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` with sequence_id and offset."""
    cells = found.withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "start"), F.lit(BUCKETS))
        .cast("int"))
    counts = stored(cells.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")),
                    "piece-counts")
    # One row per length: at most `capacity` rows.
    totals = dict(counts.groupBy("length").agg(F.sum("n")).collect())
    places = plan(totals, capacity)
    before = counts.selectExpr(
        "length", "bucket",
        "sum(n) OVER (PARTITION BY length ORDER BY bucket) - n AS before",
    )
    ranked = cells.selectExpr(
        "*", "row_number() OVER (PARTITION BY length, bucket "
        "ORDER BY doc_id, piece, start, ids_crc32) - 1 AS at",
    ).join(before, ["length", "bucket"]).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "before + at AS rank")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ranks stay below 2 ** 51 and lengths below 2 ** 12: one sorted key finds the row.
        keys = (places[:, 0] << 51) + places[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = places[np.searchsorted(keys, (length << 51) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            columns = [batch.column(c) for c in
                       ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(row[:, 4] + nth // row[:, 3]),
                 pa.array(row[:, 5] + nth % row[:, 3] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def best_fit(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every row with its place."""
    if not 0 < capacity <= CAPACITY:
        raise ValueError(f"capacity must be between 1 and {CAPACITY}")
    return pack(stored(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)

"""Removal of repeated passages by Rabin-Karp hashes of all windows of a fixed length.

Every window of `width` words gets a rolling hash, and so does every half-length gram. A window's
anchor is the least gram hash inside it, so equal windows have equal anchors. Anchors are few and
counted first; windows whose anchor stays in one document cannot repeat and are not sent on. The
other windows are counted in Spark by (hash, anchor), 128 bits together. A window that starts in
a document with a smaller id too is removed; overlapping ones merge into maximal intervals.

Defined cases: a missing or empty text has no words; a text shorter than the window loses
nothing; repeats inside one document are kept, unless a smaller id has them; rows repeated under
one id, and rows without an id, never count as each other's earlier document; columns other than
`doc_id` and `text` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settled, slices, stored, texts

WIDTH = 50
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
CACHED = 300_000


class _WordIds(dict):
    """64-bit ids of words, computed once per worker; starts afresh beyond CACHED words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes, which are weak in the low ones."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    out = []
    for factor in (BASE, inverse):
        steps = np.full(n, factor, dtype=np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps) if n else steps)
    return out[0], out[1]


class _Rolling:
    """Rolling hashes over one run of word ids."""

    def __init__(self, ids: np.ndarray):
        up, self.down = _powers(len(ids) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * up[:-1])])

    def hashes(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return _mix((self.sums[width:] - self.sums[:n]) * self.down[:n])


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours."""
    span, done = values, 1
    while 2 * done <= width:
        span = np.minimum(span[:-done], span[done:])
        done *= 2
    rest = width - done
    return np.minimum(span[: len(span) - rest], span[rest:]) if rest else span


class _Windows:
    """Window hashes and anchors of a slice of documents, laid end to end."""

    def __init__(self, batch: list[str], ids: _WordIds, width: int):
        words = [t.encode().split() for t in batch]
        self.words = words
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        flat = np.fromiter((ids[w] for doc in words for w in doc), np.uint64, int(sizes.sum()))
        rolling = _Rolling(flat)
        gram = (width + 1) // 2
        hashes = rolling.hashes(width)
        anchors = _sliding_min(rolling.hashes(gram), width - gram + 1)
        ends = np.cumsum(sizes)
        self.first = ends - sizes
        per_doc = np.maximum(sizes - width + 1, 0)
        self.doc = np.repeat(np.arange(len(batch)), per_doc)
        before = np.cumsum(per_doc) - per_doc
        self.pos = np.arange(int(per_doc.sum())) - before[self.doc]
        at = self.first[self.doc] + self.pos  # windows that stay inside one document
        self.hash, self.anchor = hashes[at], anchors[at]


def _distinct(*columns: np.ndarray) -> list[np.ndarray]:
    """The distinct rows of equally long columns."""
    order = np.lexsort(columns)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), dtype=bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return [c[new] for c in columns]


def anchors(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(anchor, doc_id): the distinct anchors of every document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for batch in slices(batches):
            found = _Windows(texts(batch), ids, width)
            # Neighbouring windows mostly share their anchor: one row per run, then per document.
            new = np.ones(len(found.doc), dtype=bool)
            new[1:] = (found.anchor[1:] != found.anchor[:-1]) | (found.doc[1:] != found.doc[:-1])
            anchor, doc = _distinct(found.anchor[new].view(np.int64), found.doc[new])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), batch.column("doc_id").take(pa.array(doc))],
                ["anchor", "doc_id"],
            )

    return docs.mapInArrow(run, "anchor long, doc_id long")


def _repeated_windows(hits: DataFrame, width: int) -> DataFrame:
    """(h, anchor, doc_id): windows of `hits(doc_id, text, anchors)` with a listed anchor."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for batch in slices(batches):
            found = _Windows(texts(batch), ids, width)
            listed = batch.column("anchors")
            keep = np.zeros(len(found.doc), dtype=bool)
            bounds = np.searchsorted(found.doc, np.arange(batch.num_rows + 1))
            for i in range(batch.num_rows):
                part = slice(bounds[i], bounds[i + 1])
                keep[part] = np.isin(found.anchor[part].view(np.int64), listed[i].values)
            h, anchor, doc = _distinct(found.hash[keep].view(np.int64),
                                       found.anchor[keep].view(np.int64), found.doc[keep])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(anchor), batch.column("doc_id").take(pa.array(doc))],
                ["h", "anchor", "doc_id"],
            )

    return hits.mapInArrow(run, "h long, anchor long, doc_id long")


def removal_windows(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, gone): per document that loses words, the hashes of the windows to remove."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = source.where("doc_id is not null")
    held = stored(anchors(known, width), "anchors")
    # Different documents share an anchor exactly if its least and largest ids differ.
    shared = settled(
        held.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b").select("anchor"), "shared-anchors",
    )
    per_doc = held.join(shared, "anchor").groupBy("doc_id").agg(
        F.collect_set("anchor").alias("anchors"))
    hits = known.join(per_doc, "doc_id").select("doc_id", "text", "anchors")
    windows = settled(_repeated_windows(hits, width), "windows", held, shared)
    first = settled(
        windows.groupBy("h", "anchor")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .where("first < last").select("h", "anchor", "first"), "repeated-windows",
    )
    return settled(
        windows.join(first, ["h", "anchor"]).where("first < doc_id")
        .groupBy("doc_id").agg(F.collect_set("h").alias("gone")), "gone", windows, first,
    )


def _intervals(hit: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal word intervals covered by windows at the given ascending starts."""
    if not len(hit):
        return []
    breaks = np.flatnonzero(np.diff(hit) > width)
    starts = hit[np.concatenate([[0], breaks + 1])]
    ends = hit[np.concatenate([breaks, [len(hit) - 1]])] + width
    return list(zip(starts.tolist(), ends.tolist(), strict=True))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept): intervals [start, end) and the kept words.

    `kept` holds the words that stay, joined by one space.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = source.join(removal_windows(docs, width), "doc_id", "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _WordIds()
        for batch in slices(batches):
            gone = batch.column("gone")
            out = {"n_words": [], "n_removed": [], "removed": [], "kept": []}
            losing = np.flatnonzero(pc.is_valid(gone).to_numpy(zero_copy_only=False))
            all_texts = texts(batch)
            found = _Windows([all_texts[i] for i in losing], ids, width)
            bounds = np.searchsorted(found.doc, np.arange(len(losing) + 1))
            spans = {}
            for k, i in enumerate(losing):
                part = slice(bounds[k], bounds[k + 1])
                hit = np.isin(found.hash[part].view(np.int64), gone[int(i)].values)
                spans[int(i)] = _intervals(np.flatnonzero(hit), width)
            for i, text in enumerate(all_texts):
                words = text.encode().split()
                cut = spans.get(i, [])
                at, kept = 0, []
                for start, end in cut:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                out["n_words"].append(len(words))
                out["n_removed"].append(len(words) - len(kept))
                out["removed"].append([{"start": a, "end": b} for a, b in cut])
                out["kept"].append(b" ".join(kept).decode())
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["n_removed"], pa.int64()), pa.array(out["removed"], spans_type),
                 pa.array(out["kept"], pa.string())],
                ["doc_id", "n_words", "n_removed", "removed", "kept"],
            )

    return marked.select("doc_id", "text", "gone").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, "
        "removed array<struct<start: long, end: long>>, kept string",
    )

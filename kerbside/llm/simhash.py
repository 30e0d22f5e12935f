"""SimHash near-duplicates, candidates pruned by chains of segments (the pigeonring principle).

64 bits are cut into six segments on a ring. If two fingerprints differ in at most 3 bits, then
some segment starts a chain whose first l segments together differ in at most 3 * l / 6 bits,
for every l from 1 to 6. Such a chain leaves three segments equal, so fingerprints meet in
buckets of three equal segments (20 choices of 31 to 33 bits); a pair of a bucket goes on only if
it has a chain within the budgets; what is left gets the full Hamming check.

Defined cases: a missing or empty text has fingerprint zero and links like any other; a text of
one or two words is hashed as a whole; equal texts share a component; rows repeated under one
id are one node; rows without an id take the least id they reach (none: null).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, stored, texts
from kerbside.llm.components import components

SEED = 42
# FIXED VALUES: first bit of each ring segment, and the end.
EDGES = (0, 11, 22, 32, 43, 54, 64)
# Members of one bucket that a task compares among themselves; larger buckets go in blocks.
BLOCK = 2_048


def _fingerprint(text: str, words_per_shingle: int) -> int:
    words = text.encode().lower().split()  # bytes: A-Z only, white space \x20 \x09-\x0D only
    if not words:
        return 0
    last = max(len(words) - words_per_shingle, 0)
    join = b" ".join
    count, total = np.zeros(64, dtype=np.int64), 0
    for start in range(0, last + 1, 65_536):
        stop = min(start + 65_536, last + 1)
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(join(words[i : i + words_per_shingle]), SEED)
             for i in range(start, stop)),
            dtype="<u8", count=stop - start,
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
        total += stop - start
    return int(np.packbits(2 * count > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64-bit SimHash of every row's whole text as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [_fingerprint(t, words_per_shingle) for t in texts(batch)]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(signed)], ["doc_id", "fp"]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, fp long"
    )


def _bucket_keys() -> Column:
    """One long for each choice of three segments: the choice's number and the segments' bits."""

    def segment(i: int) -> Column:
        width = EDGES[i + 1] - EDGES[i]
        return F.shiftrightunsigned("fp", EDGES[i]).bitwiseAND(F.lit((1 << width) - 1))

    keys = []
    for number, chosen in enumerate(combinations(range(6), 3)):
        key = F.lit(number).cast("long")
        for i in chosen:
            key = F.shiftleft(key, EDGES[i + 1] - EDGES[i]).bitwiseOR(segment(i))
        keys.append(key)
    return F.array(*keys)


def _within_budget(differing: np.ndarray, distance: int) -> np.ndarray:
    """Pairs (differing bits) with a chain whose prefixes all stay within their budgets."""
    n = len(EDGES) - 1
    parts = [
        np.bitwise_count((differing >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1))
        for low, high in zip(EDGES, EDGES[1:], strict=False)
    ]
    found = np.zeros(len(differing), dtype=bool)
    for start in range(n):
        total, good = np.zeros(len(differing), dtype=np.int64), np.ones(len(differing), dtype=bool)
        for length in range(1, n + 1):
            total += parts[(start + length - 1) % n]
            good &= n * total <= distance * length
        found |= good
    return found


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) reduced to one link per node, to the least node of its component."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if np.array_equal(before, root):
            break
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links(classes: DataFrame, distance: int = 3) -> DataFrame:
    """(a, b): links among distinct fingerprints `fp`, thinned to forests with equal components.

    Buckets are counted before they are formed. One above BLOCK members is cut into blocks by a
    hash, and pairs of blocks go to different tasks, so no task holds more than two blocks.
    """
    if distance > 3:
        raise ValueError("three equal segments of six hold for at most 3 differing bits")
    keys = classes.select("fp", F.explode(_bucket_keys()).alias("key"))
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = (
        keys.join(stored(sizes, "bucket-sizes"), "key")
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"), "fp")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                             for i in range(4)], axis=1)
            held.append(rows)
            rows = np.concatenate(held)
            # The last group may go on in the next batch.
            first = int(np.argmax((rows[:, :3] == rows[-1, :3]).all(axis=1)))
            held = [rows[first:]]
            yield from compare(rows[:first])
        if held:
            yield from compare(np.concatenate(held))

    def compare(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(np.any(np.diff(rows[:, :3], axis=0, prepend=rows[:1, :3]), axis=1))
        value = np.ascontiguousarray(rows[:, 3]).view(np.uint64)
        at, found_a, found_b, step = np.arange(len(rows)), [], [], 0
        while len(at):
            step += 1
            at = at[at + step < len(rows)]
            at = at[group[at] == group[at + step]]
            differing = value[at] ^ value[at + step]
            chained = _within_budget(differing, distance)
            close = np.flatnonzero(chained)[np.bitwise_count(differing[chained]) <= distance]
            found_a.append(value[at[close]])
            found_b.append(value[at[close] + step])
            if sum(map(len, found_a)) > 1_000_000:
                a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
                found_a, found_b = [a], [b]
        if found_a and sum(map(len, found_a)):
            a, b = _forest(np.concatenate(found_a), np.concatenate(found_b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

    return (
        members.repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "fp")
        .mapInArrow(run, "a long, b long")
    )


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = 3, distance: int = 3
) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row; component_id is the least id reachable."""
    found = stored(fingerprints(docs, words_per_shingle), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(links(classes, distance))
    linked = roots.join(classes, roots["node"] == classes["fp"]).select("node", "root", "least")
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(linked.join(ids, "root").select(F.col("node").alias("fp"), "component_id"),
                   "components")
    labels = stored(
        classes.join(named, "fp", "left")
        .select("fp", F.coalesce("component_id", "least").alias("component_id")), "labels",
    )
    return found.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

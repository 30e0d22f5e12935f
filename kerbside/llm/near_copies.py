"""Near copies by SimHash, then by exact Jaccard similarity of word shingles: an all-pairs join over
set prefixes, which spares pairs that SimHash has linked.

Two sets with a similarity of 4/5 or more share one of the first n - ceil(4n/5) + 1 elements of
either, in any order of all elements that both follow. Sets meet in buckets of one prefix element;
length and position bound what a pair can share. A bitmap of each set, a few bits an element,
bounds it again: a bit that only one of two sets has stands for an element that the other lacks.
What is left is compared whole. The order puts elements that a sample finds in several sets last,
the most frequent at the end, which changes how many pairs meet, not the result: a set has such an
element in its prefix only if it has few others, so buckets stay small as the corpus grows.

A bucket's members are first compared with its smallest one and with their neighbours in length;
all pairs not joined by then follow. So a large group of copies is not compared pair by pair.

Defined cases: white space and letter case as in `simhash`; a text under five words is one
shingle; missing and empty texts are near copies of each other; rows repeated under one id are one
node; rows without an id link like others and take the least id they reach (none: null).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import settled, slices, texts
from kerbside.llm.components import components
from kerbside.llm.simhash import SEED, near_duplicates

WORDS = 5
# Similarity of 4/5 or more.
PART, WHOLE = 4, 5
# Members of one bucket that a task compares among themselves; larger buckets go in blocks.
BLOCK = 2_048
# One set in SAMPLE is looked at for common elements; at most COMMON, the most frequent, go last.
SAMPLE, COMMON = 16, 500_000


def shingles(text: str) -> np.ndarray:
    """The sorted set of 64-bit hashes of a text's shingles."""
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, dtype=np.int64)
    join = b" ".join
    hashes = {xxhash.xxh64_intdigest(join(found[i : i + WORDS]), SEED)
              for i in range(max(len(found) - WORDS + 1, 1))}
    return np.sort(np.fromiter(hashes, dtype="<u8", count=len(hashes)).view(np.int64))


def _node(items: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(items.tobytes(), SEED)


def _bitmap(items: np.ndarray) -> bytes:
    """A bit for each element, by its low bits; two to four bits an element in all."""
    width = max(64, 1 << (2 * len(items)).bit_length())
    flags = np.zeros(width, dtype=bool)
    flags[items & (width - 1)] = True
    return np.packbits(flags).tobytes()


def _may_share(n: int, m: int, left: bytes, right: bytes) -> bool:
    """Whether sets of n and m elements with these bitmaps can be similar."""
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    size = min(len(a), len(b))
    # The longer one is folded: its elements' lower bits count.
    a = np.bitwise_or.reduce(a.reshape(-1, size), axis=0)
    b = np.bitwise_or.reduce(b.reshape(-1, size), axis=0)
    shared = min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))
    return (PART + WHOLE) * shared >= PART * (n + m)


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))


def _nodes(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def shingle_sets(texts_: DataFrame) -> DataFrame:
    """(node, items): the set of every row's text, and the set's hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([_nodes(list(map(_node, found))), _lists(found)],
                                             ["node", "items"])

    return texts_.select("text").mapInArrow(run, "node long, items array<long>")


def _common(source: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Elements that a sample finds more than once, sorted, and each one's place by frequency, the
    most frequent first. At most COMMON, whatever the corpus: a hint for the order, none is left
    out."""
    sample = shingle_sets(source.where(f"pmod(h, {SAMPLE}) = 0").dropDuplicates(["h"])).select(
        F.explode("items").alias("item"))
    counts = settled(sample.groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                     "common")
    # The least frequency that no more than COMMON elements reach: a histogram decides.
    least, reached = None, 0
    for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("items")).orderBy(
            F.col("n").desc()).toLocalIterator():
        reached += r["items"]
        if reached > COMMON:
            break
        least = r["n"]
    if least is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found = counts.where(F.col("n") >= least).toArrow()
    item, n = (found.column(c).to_numpy().astype(np.int64) for c in ("item", "n"))
    falling = np.lexsort((item, -n))
    at = np.argsort(item[falling])
    return item[falling][at], at


def _prefixes(source: DataFrame) -> DataFrame:
    """(doc_id, h, node, n, prefix, bits) of rows (doc_id, text, h): the set's hash, size, prefix
    and bitmap."""
    ordered, places = _common(source)

    def prefix(items: np.ndarray) -> np.ndarray:
        keep = len(items) - -(-PART * len(items) // WHOLE) + 1 if len(items) else 0
        if len(ordered) and keep:
            at = np.minimum(np.searchsorted(ordered, items), len(ordered) - 1)
            hit = ordered[at] == items
            # The most common of all come last.
            items = np.concatenate([items[~hit], items[hit][np.argsort(-places[at[hit]])]])
        return items[:keep]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [shingles(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), _nodes(list(map(_node, found))),
                 pa.array(list(map(len, found)), pa.int64()), _lists(list(map(prefix, found))),
                 pa.array(list(map(_bitmap, found)), pa.binary())],
                ["doc_id", "h", "node", "n", "prefix", "bits"])

    return source.mapInArrow(
        run, "doc_id long, h long, node long, n long, prefix array<long>, bits binary")


def _possible(found: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a similarity of 4/5."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n", "m", "left", "right")]
            keep = pa.array([_may_share(*row) for row in zip(*columns, strict=True)], pa.bool_())
            yield batch.select(["a", "b"]).filter(keep)

    a = sets.select(F.col("node").alias("a"), "n", F.col("bits").alias("left"))
    b = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("bits").alias("right"))
    return found.join(a, "a").join(b, "b").select("a", "b", "n", "m", "left", "right").mapInArrow(
        run, "a long, b long")


def _candidates(members: DataFrame, first: bool) -> DataFrame:
    """(a, b): pairs of a bucket that can be similar and whose roots differ.

    With `first`, only pairs with the bucket's smallest set and with the next one in length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 7), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack(
                [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64)
                 for i in range(7)], axis=1)])
            # The last group may go on in the next batch.
            start = int(np.argmax((rows[:, :3] == rows[-1, :3]).all(axis=1)))
            held = rows[start:]
            yield from compare(rows[:start])
        yield from compare(held)

    def compare(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(rows):
            return
        new = np.any(np.diff(rows[:, :3], axis=0, prepend=rows[:1, :3]), axis=1)
        group = np.cumsum(new)
        root = rows[:, 6]
        # Only buckets that hold more than one root.
        mixed = np.zeros(group[-1] + 1, dtype=bool)
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        mixed[group[root != root[starts][group]]] = True
        rows = rows[mixed[group]]
        if not len(rows):
            return
        group = group[mixed[group]]
        n, at, node, root = rows[:, 3], rows[:, 4], rows[:, 5], rows[:, 6]

        def pairs(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            shared = np.minimum(n[i] - at[i], n[j] - at[j])
            good = ((PART + WHOLE) * shared >= PART * (n[i] + n[j])) & (root[i] != root[j])
            return node[i[good]], node[j[good]]

        found, size = [], 0

        def emit() -> pa.RecordBatch:
            both = np.unique(np.sort(np.concatenate(
                [np.stack(p, axis=1) for p in found]), axis=1), axis=0)
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])],
                                              ["a", "b"])

        where, step = np.arange(len(rows)), 0
        if first:
            starts = np.flatnonzero(np.diff(group, prepend=-1))
            head = np.repeat(starts, np.diff([*starts, len(rows)]))
            found.append(pairs(head, where))
        while len(where) and not (first and step):
            step += 1
            where = where[where + step < len(rows)]
            where = where[group[where] == group[where + step]]
            where = where[WHOLE * n[where] >= PART * n[where + step]]  # in order of length
            found.append(pairs(where, where + step))
            size += len(found[-1][0])
            if size > 1_000_000:
                yield emit()
                size = 0
        if found:
            yield emit()

    return (
        members.repartition("item", "low", "high")
        .sortWithinPartitions("item", "low", "high", "n", "node")
        .mapInArrow(run, "a long, b long").distinct()
    )


def same_fingerprints(source: DataFrame, whole: DataFrame) -> DataFrame:
    """(a, b): each set that SimHash links to others, with the least set of its SimHash group.

    `source` has (text, h), `whole` the set (node) of each text (h).
    """
    grouped = near_duplicates(source.select(F.col("h").alias("doc_id"), "text")).select(
        F.col("doc_id").alias("h"), F.col("component_id").alias("group")).distinct()
    members = settled(whole.select("h", "node").distinct().join(grouped, "h")
                      .select("group", "node").distinct(), "simhash-groups")
    least = members.groupBy("group").agg(F.min("node").alias("b"))
    return settled(members.join(least, "group").where("node != b")
                   .select(F.col("node").alias("a"), "b").distinct(), "simhash-links", members)


def similar(source: DataFrame, sets: DataFrame, known: DataFrame) -> DataFrame:
    """(a, b): links among distinct sets (node, n, prefix, bits, h) whose components are those of all
    pairs with a similarity of 4/5 or more and of the `known` links (a, b), whose ends are not
    compared again. Whole sets are read again from `source` (text, h), for the pairs that need
    them."""
    prefixes = sets.select("node", "n", F.posexplode("prefix").alias("at", "item"))
    sizes = settled(prefixes.groupBy("item").agg(F.count(F.lit(1)).alias("size"))
                    .where("size > 1"), "sizes")
    members = settled(
        prefixes.join(sizes, "item").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("item", F.least("own", "other").alias("low"),
                F.greatest("own", "other").alias("high"), "n", "at", "node"), "members", sizes)

    def verified(found: DataFrame, *consumed: DataFrame) -> DataFrame:
        pairs = settled(found, "pairs", *consumed)
        found = settled(_possible(pairs, sets), "candidates", pairs)
        nodes = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = settled(sets.select("node", "h").join(nodes, "node", "left_semi"), "wanted")
        whole = settled(shingle_sets(
            source.join(wanted, "h", "left_semi").groupBy("h").agg(F.first("text").alias("text"))),
            "whole", wanted)
        a = whole.select(F.col("node").alias("a"), F.col("items").alias("left"))
        b = whole.select(F.col("node").alias("b"), F.col("items").alias("right"))
        shared = F.size(F.array_intersect("left", "right"))
        return settled(found.join(a, "a").join(b, "b").where(
            (PART + WHOLE) * shared >= PART * (F.size("left") + F.size("right"))).select("a", "b"),
            "links", found, whole)

    def rooted(links: DataFrame) -> DataFrame:
        roots = components(links).select("node", "root")
        return members.join(roots, "node", "left").select(
            *members.columns, F.coalesce("root", "node").alias("root"))

    near = known.unionByName(verified(_candidates(rooted(known), True)))
    return near.unionByName(verified(_candidates(rooted(near), False), members))


def near_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id) per row; component_id is the least id reachable.

    SimHash links documents first, by its own rule; the join adds the near copies that it leaves.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    whole = settled(_prefixes(source), "prefixes")
    sets = settled(whole.groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first(F.struct("n", "h", "prefix", "bits")).alias("s"))
        .select("node", "least", "s.*"), "sets")
    known = same_fingerprints(source, whole)
    rows = settled(whole.select("doc_id", "node"), "nodes", whole)
    linked = components(similar(source, sets, known))
    classes = settled(
        sets.select("node", "least").join(linked, "node", "left")
        .select("node", F.coalesce("root", "node").alias("root"), "least"), "classes", sets)
    ids = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = settled(classes.join(ids, "root").select("node", "component_id"), "components",
                    classes)
    return rows.join(named, "node").select("doc_id", "component_id")

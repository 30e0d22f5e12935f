"""Collocations: frequent phrases whose parts occur together more often than apart.

Words of a text have polynomial hashes; prefix sums of them give the fingerprint of every n-gram
of a piece by one subtraction. A task counts its fingerprints and sends them packed, by language,
length and shard, each with a document that holds it. A shard's rows are added up, and only
fingerprints that are frequent go on: the documents they point to are read again, and the
phrases written out. A fingerprint has 96 bits of two independent polynomials; the first and the
last document of each must yield the same text, or the whole count is repeated with other bases.

Defined cases: a missing text has no words, a missing language is `und`; texts and languages may
be repeated; columns other than `doc_id`, `text` and `lang` are ignored; no documents, or none
with a frequent phrase, give no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import received, settled, slices, stored, texts

MIN_COUNT = 10
LONGEST = 3
TOP = 2_000
UNKNOWN = "und"
# Entries that a task holds before it merges them, and bytes of packed entries in a shard.
HELD = 3_000_000
SHARD_BYTES = 4_000_000
LEAST_SHARDS = 1_024
# Words whose numbers a task keeps; bytes of text that it counts, and that it receives, at a time.
# Two tasks of an executor, and what their workers do not give back, stay far below its heap.
CACHED = 250_000
SLICE = 500_000
RECEIVED = 4_000_000

_BREAK = 0xFF  # a byte that UTF-8 never uses, for the borders of pieces
_TABLE = bytes(
    _BREAK if b in b".,;:!?\n\x0b\x0c\r" else 0x20 if b == 0x09 else b + 32 if 65 <= b <= 90 else b
    for b in range(256))
_PACKED = ("shard int, lang string, size int, fingerprints binary, checks binary, counts binary, "
           "places binary, large array<long>")


class Words(dict):
    """Codes of words, with two independent 64-bit numbers each; starts afresh when full."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed, self.numbers = seed, np.zeros((2, 1_024), dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        code = len(self)
        if code == self.numbers.shape[1]:
            self.numbers = np.concatenate([self.numbers, np.zeros_like(self.numbers)], axis=1)
        self.numbers[0, code] = xxhash.xxh64_intdigest(word, self.seed)
        self.numbers[1, code] = xxhash.xxh3_64_intdigest(word, self.seed + 1)
        self[word] = code
        return code


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes, which are weak in the low ones."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _bases(seed: int) -> list[np.uint64]:
    """Odd numbers, so they have inverses modulo 2 ** 64."""
    return [np.uint64(xxhash.xxh64_intdigest(bytes([k]), seed) | 1) for k in (1, 2)]


class Grams:
    """The n-grams of a run of texts, laid end to end with borders between pieces and texts."""

    def __init__(self, batch: list[str], known: Words, bits: int = 64):
        if len(known) > CACHED:
            known.clear()
        parts = [t.encode().translate(_TABLE) for t in batch]
        blob = b"\xff".join(parts)
        self.words = blob.replace(b"\xff", b" \xff ").split()
        code = np.fromiter(map(known.__getitem__, self.words), np.int64, len(self.words))
        border = code == known[b"\xff"]
        # Words from here to the next border.
        ends = np.append(np.flatnonzero(border), len(code))
        self.left = ends[np.cumsum(border) - border] - np.arange(len(code))
        self.sums, self.down, self.bits = [], [], bits
        for numbers, base in zip(known.numbers, _bases(known.seed), strict=True):
            up = np.full(len(code) + 1, base)
            up[0] = 1
            np.multiply.accumulate(up, out=up)
            down = np.full(len(code) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
            down[0] = 1
            np.multiply.accumulate(down, out=down)
            self.sums.append(np.concatenate([np.zeros(1, np.uint64),
                                             np.cumsum(numbers[code] * up[:-1])]))
            self.down.append(down)
        # Texts are parted by one border each, beyond those inside them.
        borders = np.cumsum([p.count(b"\xff") + 1 for p in parts])
        self.doc = np.searchsorted(borders, np.cumsum(border) - border, side="right")

    def of(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, fingerprints and 32-bit checks of all n-grams of a size."""
        at = np.flatnonzero(self.left >= size)
        a, b = (
            _mix((s[at + size] - s[at]) * d[at] + np.uint64(size))
            for s, d in zip(self.sums, self.down, strict=True))
        if self.bits < 64:  # weak fingerprints, for tests
            a, b = a >> np.uint64(64 - self.bits) << np.uint64(64 - self.bits), b * np.uint64(0)
        return at, a, (b >> np.uint64(32)).astype(np.uint32)


def _add_up(a: np.ndarray, b: np.ndarray, counts: np.ndarray, first: np.ndarray,
            last: np.ndarray | None = None, sort: str = "stable") -> tuple[np.ndarray, ...]:
    """Rows of equal (a, b) added up, in order: counts summed, the least first and largest last.

    The stable sort is the faster one for rows that come in sorted runs, and only for them.
    """
    lasts = () if last is None else (last,)
    if not len(a):
        return a, b, counts, first, *lasts
    order = np.argsort(a, kind=sort)
    a, b_in_order = a[order], b[order]
    new = np.append(True, a[1:] != a[:-1])
    if np.any(~new[1:] & (b_in_order[1:] != b_in_order[:-1])):
        within = np.lexsort((b_in_order, a))
        order, a, b_in_order = order[within], a[within], b_in_order[within]
        new[1:] |= b_in_order[1:] != b_in_order[:-1]
    b, new = b_in_order, np.flatnonzero(new)
    return (a[new], b[new], np.add.reduceat(counts[order], new),
            np.minimum.reduceat(first[order], new),
            *(np.maximum.reduceat(x[order], new) for x in lasts))


def _source(docs: DataFrame) -> DataFrame:
    """(lang, text, place): `place` is a 32-bit hash of the document, to which entries point."""
    return docs.select(
        F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
        F.shiftrightunsigned(F.xxhash64("doc_id", "lang", "text"), 32).cast("long").alias("place"))


def _packed_counts(source: DataFrame, seed: int, longest: int, shard_bits: int,
                   bits: int) -> DataFrame:
    """Packed entries by shard, language and size: what each task counted."""

    def emit(lang: str, size: int, rows: tuple[np.ndarray, ...]) -> Iterator[dict]:
        a, b, counts, first = rows
        shard = (a >> np.uint64(64 - shard_bits)).astype(np.int64)
        starts = np.flatnonzero(np.diff(shard, prepend=-1))
        low = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]  # the shard has the rest
        small = np.minimum(counts, 255).astype(np.uint8)
        for i, j in zip(starts, [*starts[1:], len(a)], strict=True):
            yield {
                "shard": int(shard[i]), "lang": lang, "size": size,
                "fingerprints": low[i:j].tobytes(), "checks": b[i:j].astype("<u4").tobytes(),
                "counts": small[i:j].tobytes(), "places": first[i:j].astype("<u4").tobytes(),
                "large": counts[i:j][small[i:j] == 255].tolist(),
            }

    schema = pa.schema([
        ("shard", pa.int32()), ("lang", pa.string()), ("size", pa.int32()),
        ("fingerprints", pa.binary()), ("checks", pa.binary()), ("counts", pa.binary()),
        ("places", pa.binary()), ("large", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(seed)
        held: dict[tuple[str, int], list[tuple[np.ndarray, ...]]] = {}
        entries = 0

        def merged() -> None:
            for key, parts in held.items():
                if len(parts) > 1:
                    columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                    parts.clear()
                    held[key] = [_add_up(*columns)]

        def flush() -> Iterator[pa.RecordBatch]:
            merged()
            while held:
                (lang, size), parts = held.popitem()
                for rows in itertools.batched(emit(lang, size, parts[0]), 256):
                    yield pa.RecordBatch.from_pylist(rows, schema)

        for batch in slices(batches, limit=SLICE):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            names, lang_of = np.unique(langs.astype(str), return_inverse=True)
            places = batch.column("place").to_numpy(zero_copy_only=False).astype(np.uint32)
            found = Grams(texts(batch), known, bits)
            for size in range(1, longest + 1):
                at, a, b = found.of(size)
                doc = found.doc[at]
                for k, lang in enumerate(names.tolist()):
                    mine = lang_of[doc] == k if len(names) > 1 else slice(None)
                    place = places[doc[mine]]
                    if len(place):
                        ones = np.ones(len(place), np.int64)
                        part = _add_up(a[mine], b[mine], ones, place, sort="quicksort")
                        held.setdefault((lang, size), []).append(part)
                        entries += len(part[0])
            if entries > HELD:
                merged()
                entries = sum(len(p[0]) for parts in held.values() for p in parts)
                if entries > HELD:
                    yield from flush()
                    entries = 0
        yield from flush()

    return source.mapInArrow(run, _PACKED)


def _unpack(table: pa.Table, shard_bits: int) -> tuple[np.ndarray, ...]:
    def joined(name: str, dtype: str) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)

    low = joined("fingerprints", "u1").reshape(-1, 7)
    full = np.zeros((len(low), 8), dtype=np.uint8)
    full[:, :7] = low
    sizes = np.array([len(c) for c in table.column("counts").to_pylist()])
    top = np.repeat(table.column("shard").to_numpy().astype(np.uint64), sizes)
    counts = joined("counts", "u1").astype(np.int64)
    large = [v for row in table.column("large").to_pylist() for v in row]
    counts[counts == 255] = large
    # Shards have eight bits or more, so they hold the byte that was left out.
    a = full.view("<u8").reshape(-1) | (top >> np.uint64(shard_bits - 8) << np.uint64(56))
    places = joined("places", "<u4")
    return a, joined("checks", "<u4"), counts, places, places


def _frequent(packed: DataFrame, min_count: int, shard_bits: int) -> DataFrame:
    """Per language and size the frequent fingerprints; per shard and language also one row with
    the number of words (`fingerprint` null)."""
    schema = pa.schema([
        ("lang", pa.string()), ("size", pa.int32()), ("fingerprint", pa.int64()),
        ("check", pa.int64()), ("f", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        kinds = table.select(["lang", "size"]).group_by(["lang", "size"]).aggregate([]).to_pylist()
        out = []
        for kind in kinds:
            mine = pc.and_(pc.equal(table.column("lang"), kind["lang"]),
                           pc.equal(table.column("size"), kind["size"]))
            a, b, counts, first, last = _add_up(*_unpack(table.filter(mine), shard_bits))
            good = counts >= min_count
            n = int(good.sum())
            columns = [a[good].view(np.int64), b[good], counts[good], first[good], last[good]]
            out.append(pa.table(
                [pa.array([kind["lang"]] * n, pa.string()), pa.array([kind["size"]] * n, pa.int32()),
                 *(pa.array(c.astype(np.int64)) for c in columns)], schema=schema))
            if kind["size"] == 1:
                total = {"lang": kind["lang"], "size": 1, "f": int(counts.sum())}
                out.append(pa.Table.from_pylist([total], schema=schema))
        return pa.concat_tables(out)

    return packed.groupBy("shard").applyInArrow(
        run, "lang string, size int, fingerprint long, check long, f long, first long, last long")


def _phrases(source: DataFrame, keys: DataFrame, seed: int, bits: int, longest: int) -> DataFrame:
    """(lang, size, fingerprint, check, phrase) as the documents that keys point to have them."""
    wanted = (
        keys.select("lang", F.explode(F.array_distinct(F.array("first", "last"))).alias("place"),
                    F.struct("size", "fingerprint", "check").alias("key"))
        .groupBy("lang", "place").agg(F.collect_list("key").alias("keys"))
    )
    schema = "lang string, size int, fingerprint long, check long, phrase string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words(seed)
        for batch in slices(batches):
            for row in range(batch.num_rows):
                found = Grams([batch.column("text")[row].as_py()], known, bits)
                keys = batch.column("keys")[row].values
                key_size = keys.field("size").to_numpy()
                out: list[list] = [[], [], [], []]
                for size in range(1, longest + 1):
                    mine = key_size == size
                    a = keys.field("fingerprint").to_numpy()[mine].view(np.uint64)
                    b = keys.field("check").to_numpy()[mine]
                    at, fps, checks = found.of(size)
                    # The first place in the text of each key.
                    fps, where = np.unique(fps, return_index=True)
                    spot = np.minimum(np.searchsorted(fps, a), len(fps) - 1) if len(fps) else None
                    if spot is None:
                        continue
                    hit = (fps[spot] == a) & (checks[where[spot]] == b)
                    starts = at[where[spot[hit]]]
                    out[0] += [size] * len(starts)
                    out[1] += a[hit].view(np.int64).tolist()
                    out[2] += b[hit].tolist()
                    out[3] += [b" ".join(found.words[i : i + size]).decode()
                               for i in starts.tolist()]
                n = len(out[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("lang")[row].as_py()] * n, pa.string()),
                     pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                    ["lang", "size", "fingerprint", "check", "phrase"])

    return source.join(wanted, ["lang", "place"]).select("lang", "text", "keys").mapInArrow(
        run, schema)


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT,
                  bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, f) of phrases of up to `longest` words that occur `min_count` times or
    more, and (lang, n): the number of words.

    `bits` cuts the fingerprints, so that tests can make them collide.
    """
    source = _source(docs)
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Packed entries take about as many bytes as three times the text, at most.
    shards = max(LEAST_SHARDS, 3 * total // SHARD_BYTES)
    shard_bits = int(shards - 1).bit_length()
    key = ["lang", "size", "fingerprint", "check"]
    for seed in itertools.count(0, 10):
        width = 64 if seed else bits
        packed = _packed_counts(source, seed, longest, shard_bits, width)
        with received(docs.sparkSession, RECEIVED):
            # The packed entries' shuffle files go before the texts are shuffled.
            found = settled(_frequent(packed, min_count, shard_bits), "fingerprints")
            keys = found.where("fingerprint is not null")
            written = settled(_phrases(source, keys, seed, width, longest).distinct(), "phrases")
        texts_of = written.groupBy(*key).agg(F.count(F.lit(1)).alias("texts"))
        if keys.join(texts_of, key, "left").where("coalesce(texts, 0) != 1").isEmpty():
            break
    counts = keys.join(written, key).select("lang", "size", "phrase", "f")
    words = found.where("fingerprint is null and size = 1").groupBy("lang").agg(
        F.sum("f").alias("n"))
    return stored(counts, "counts"), words


def collocations(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT,
                 top: int = TOP, share: int = 50, bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of 2 words or more.

    A phrase scores floor(1000000 * a * a / (l * r)) at its worst cut. It is left out if a longer
    phrase that holds it has at least `share` hundredths of its count.
    """
    counts, totals = phrase_counts(docs, longest, min_count, bits)
    candidates = counts.where("size > 1").withColumn("words", F.split("phrase", " ", -1))
    parts = counts.select("lang", "phrase", "f")
    cuts = candidates.select(
        "lang", "phrase", "size", "words", F.col("f").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "size", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    # Decimals, because products may pass 64 bits; the score is at most a million.
    score = F.expr("cast(1000000 * cast(a AS decimal(14,0)) * cast(a AS decimal(14,0)) "
                   "div (cast(l AS decimal(16,0)) * cast(r AS decimal(16,0))) AS long)")
    scored = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
        .withColumn("score", score).groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
        .select("lang", "phrase", "cut.*")
    )
    def parts_of(size: int) -> DataFrame:
        """The phrases of a size inside longer candidates."""
        starts = F.sequence(F.lit(1), F.col("size") - size + 1)
        inner = F.transform(starts, lambda i: F.array_join(F.slice("words", i, size), " "))
        return candidates.where(F.col("size") > size).select(
            "lang", F.col("f").alias("longer"), F.explode(inner).alias("phrase"))

    inside = [parts_of(size) for size in range(2, longest)]
    if inside:
        held = reduce(DataFrame.unionByName, inside).groupBy("lang", "phrase").agg(
            F.max("longer").alias("longer"))
        scored = scored.join(held, ["lang", "phrase"], "left").where(
            F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        scored.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                "score")
    )

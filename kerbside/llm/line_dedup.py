"""Line deduplication: which lines of a document to keep, as bitmaps.

Line hashes are range-partitioned with their document and sorted by hash, document (largest
first) and position, so a line that a third of all documents hold spreads over many ranges. The
first occurrence in a range names its keeper there; one small aggregate merges the ranges.

Defined cases: a missing or empty text is one empty line; rows without an id hold no shared line
and lose none; rows repeated under one id count as one document; equal lines inside the keeper
all stay; a document may lose every line and is then empty; columns other than `doc_id` and
`text` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored

# FIXED VALUES: white space stripped from a line, letters folded in its key.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

WORD = 64  # lines per bitmap word


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _key(line: Column) -> Column:
    """The stripped line with A-Z in lower case; other letters keep their case."""
    bare = F.btrim(line, F.lit(SPACES))
    plain = F.length(bare) == F.octet_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def line_hashes(docs: DataFrame, min_chars: int = 20) -> DataFrame:
    """(doc_id, version, pos, h1, h2): the 128-bit hash of every line that is long enough.

    `version` tells apart rows that share an id but not their text.
    """
    lines = docs.where("doc_id is not null").select(
        "doc_id", F.xxhash64(_text()).alias("version"),
        F.posexplode(F.split(_text(), "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.select("doc_id", "version", "pos", _key(F.col("line")).alias("key"))
    return keyed.where(F.length("key") >= min_chars).select(
        "doc_id", "version", "pos", F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
    )


def shared_lines(hashes: DataFrame, min_docs: int = 3) -> DataFrame:
    """(h1, h2, keeper): lines of at least `min_docs` documents and the largest id of them."""
    ranged = hashes.repartitionByRange("h1", "h2", F.col("doc_id").desc()).sortWithinPartitions(
        "h1", "h2", F.col("doc_id").desc(), "pos"
    )
    # The ranges already hold a document's copies of a line together: no shuffle here.
    first = ranged.groupBy("h1", "h2", "doc_id").agg(F.min("pos").alias("pos"))
    return (
        first.groupBy("h1", "h2")
        .agg(F.max("doc_id").alias("keeper"), F.count(F.lit(1)).alias("docs"))
        .where(F.col("docs") >= min_docs).select("h1", "h2", "keeper")
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc_id, version, n_dropped, gone): the documents that lose lines.

    The bitmap is compressed: `gone` lists only words of 64 lines in which a line goes, as
    (word, bits), a set bit marking a line to drop. Documents not listed keep everything.
    """
    hashes = stored(line_hashes(docs, min_chars), "line-hashes")
    shared = stored(shared_lines(hashes, min_docs), "shared-lines")
    words = (
        hashes.join(shared, ["h1", "h2"]).where("doc_id <> keeper")
        .groupBy("doc_id", "version", F.expr(f"pos div {WORD}").cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits"))
    )
    return words.groupBy("doc_id", "version").agg(
        F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("gone"),
    )


def apply_keep(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row of `docs` as a struct, with its kept text."""
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("of_doc"),
        F.xxhash64(_text()).alias("of_version"), _text().alias("whole"),
    )
    both = rows.join(
        bitmaps.select(F.col("doc_id").alias("of_doc"), F.col("version").alias("of_version"),
                       "n_dropped", "gone"),
        ["of_doc", "of_version"], "left",
    )

    def stays(_, i):
        bits = F.coalesce(F.try_element_at("gone", F.floor(i / WORD).cast("int")),
                          F.lit(0).cast("long"))
        return F.getbit(bits, i % WORD) == 0

    kept = F.array_join(F.filter(F.split("whole", "\n", -1), stays), "\n")
    return both.select(
        "row",
        (F.length("whole") - F.length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("whole")).otherwise(kept).alias("kept"),
    )


def drop_shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """`apply_keep` with the bitmaps of the same documents."""
    return apply_keep(docs, keep_bitmaps(docs, min_chars, min_docs))

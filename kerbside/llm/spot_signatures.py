"""Document fingerprints from spot signatures.

A spot is a common word directly before a content word; its signature is the chain of that
common word and the next two content words. In a run of content words, a word that has no common
word among the RUN words before it is an anchor itself. A document's fingerprint is its sorted set
of signatures. Fingerprints have a partition by set length, since the smaller set's length over the
larger one's bounds their Jaccard similarity from above; the likeness of two is the exact ratio.

Defined cases: texts of common words alone take each of their words as a signature, since they have
no chain; the rule is the same at every length; a text without any word is its own signature; a missing text is empty and has an empty fingerprint; two empty fingerprints are
alike (1). The next document of the last is the first, of a lone one itself. Rows are in order of
doc_id (missing first), then of a hash of the text. Columns other than `doc_id` and `text` are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 8
ALIKE = 0.8  # adjacent length partitions hold all sets that can be this similar

# FIXED VALUES: common words of English, German, French and Spanish.
COMMON = [
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "are", "as",
    "with", "be", "by", "this", "at", "from",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist",
    "im", "dem", "nicht", "ein", "eine", "als", "auch",
    "le", "la", "les", "de", "et", "un", "une", "du", "est", "que", "qui", "dans", "pour", "par",
    "pas", "sur", "au", "avec",
    "el", "los", "las", "y", "en", "del", "se", "con", "no", "una", "su", "al", "lo", "es", "por",
]


def signatures(text: Column) -> Column:
    """The sorted set of 64-bit signatures of a text, built from native expressions."""

    def once(value: Column, use) -> Column:
        # A lambda over one element: `value` is computed once, however often it is used.
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def chains(words: Column) -> Column:
        places = F.filter(
            F.transform(words, lambda w, i: F.when(~w.isin(COMMON), i)), lambda i: i.isNotNull())

        def chain(at: Column, p: Column, j: Column) -> Column:
            rest = [F.get(words, p), F.get(words, F.get(at, j + 1))]
            # All words before it, up to RUN of them, are content words.
            alone = F.get(at, F.greatest(j - RUN, F.lit(0))) == p - F.least(j, F.lit(RUN))
            spot = (p > 0) & (F.coalesce(F.get(at, j - 1), F.lit(-1)) < p - 1)
            return F.when(spot, F.xxhash64(F.get(words, p - 1), *rest)).when(
                alone, F.xxhash64(*rest))

        return once(places, lambda at: F.transform(at, lambda p, j: chain(at, p, j)))

    def pick(words: Column) -> Column:
        # Any content word has a chain or is an anchor.
        bare = F.forall(words, lambda w: w.isin(COMMON))
        return F.when(bare, F.transform(words, lambda w: F.xxhash64(w))).otherwise(chains(words))

    def whole(found: Column) -> Column:
        return F.when((F.size(found) == 0) & (text != ""), F.array(F.xxhash64(text))) \
            .otherwise(found)

    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    found = F.array_compact(F.array_distinct(once(words, pick)))
    return F.sort_array(once(found, whole))


def fingerprint(signatures_: Column) -> Column:
    """A set of signatures as one text of hexadecimal digits."""
    return F.array_join(F.transform(signatures_, lambda s: F.lpad(F.hex(s), 16, "0")), "")


def length_partition(signatures_: Column) -> Column:
    """Number of the set's length partition; sets alike by ALIKE are at most one apart."""
    return F.floor(F.ln(F.size(signatures_) + 1) / F.lit(math.log(1 / ALIKE))).cast("int")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets; two empty ones are alike."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either == 0, F.lit(1.0)).otherwise(shared.cast("double") / either)


def in_ranges(docs: DataFrame, ranges: int) -> tuple[DataFrame, DataFrame]:
    """The rows in id ranges, and each range's following row.

    First: (doc_id, text, h, range), a range holding rows next to each other in id order and
    about as many as any other. Second: (range, first_text), the first text of the range after
    it; after the last comes the first.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text"))
    # At most `ranges` numbers, whatever the corpus.
    cuts = source.agg(F.percentile_approx(
        "doc_id", [i / ranges for i in range(1, ranges)] or [0.5], 100 * ranges)).first()[0] or []
    place = F.lit(0)
    if cuts:
        below = F.filter(F.array(*map(F.lit, sorted(set(cuts)))), lambda c: c < F.col("doc_id"))
        place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(F.size(below))
    placed = source.select("doc_id", "text", F.xxhash64("text").alias("h"), place.alias("range"))
    heads = placed.groupBy("range").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "h")).alias("m"))
    # One row per range: at most `ranges` rows, a proven bound.
    order = heads.selectExpr(
        "range AS next_range", "m",
        "lag(range) OVER (ORDER BY range) AS before", "max(range) OVER () AS last",
    ).selectExpr("next_range", "m", "coalesce(before, last) AS range")
    firsts = (
        placed.withColumnRenamed("range", "next_range").join(F.broadcast(order), "next_range")
        .where("doc_id <=> m.doc_id AND h = m.h")
        .groupBy("range").agg(F.max("text").alias("first_text"))
    )
    return placed, firsts


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter replaced by as many first characters of another."""
    n = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n),
                    F.substring(following, F.lit(1), n))


def spot_fingerprints(docs: DataFrame, ranges: int) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other.

    (doc_id, n_chars, n_signatures, length_partition, edited_text, fingerprint,
    edited_fingerprint, near_edited, near_next)
    """
    placed, firsts = in_ranges(docs, ranges)
    following = "lead({}) OVER (PARTITION BY range ORDER BY doc_id NULLS FIRST, h)"
    firsts = firsts.select("range", "first_text", signatures(F.col("first_text")).alias("first"))
    texts = placed.selectExpr("*", f"{following.format('text')} AS next_text").join(
        firsts, "range").select(
        "doc_id", "h", "range", "first", F.length("text").cast("long").alias("n_chars"),
        signatures(F.col("text")).alias("own"),
        edited(F.col("text"), F.coalesce("next_text", "first_text")).alias("edited_text"),
    )
    sets = texts.selectExpr("*", f"{following.format('own')} AS next_own").select(
        "doc_id", "n_chars", "own", "edited_text", F.coalesce("next_own", "first").alias("next"),
        signatures(F.col("edited_text")).alias("other"),
    )
    return sets.select(
        "doc_id", "n_chars", F.size("own").cast("long").alias("n_signatures"),
        length_partition(F.col("own")).alias("length_partition"), "edited_text",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )

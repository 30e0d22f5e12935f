"""Quality rules kept as a ledger: every rule is evaluated once per document and stored as a bit.

A policy is a version and a mask of rules. Applying another policy, or asking what a rule alone
rejects, reads the ledger and never the texts.

Defined cases: a missing or empty text has no words and fails `few_words`; repeated rows are
judged one by one; an empty table gives an empty ledger; columns other than `doc_id` and `text`
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import slices, texts

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

# FIXED VALUES: white space between words, characters that count as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Rule name: its condition on the measurements. A rule's bit is its place in this list; new
# rules go to the end. Whole-number arithmetic, so that every engine agrees on the border.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "10 * word_chars < 25 * n_words",
    "long_words": "word_chars > 12 * n_words",
}

# Policy version: the rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}


def _repeated(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur at least twice in one text."""
    if len(ids) < 4:
        return 0
    width = int(ids.max()) + 1
    if width < 2_000_000:  # three ids fit into 63 bits
        windows = (ids[:-2] * width + ids[1:-1]) * width + ids[2:]
        _, group, count = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        windows = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        _, group, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)
    twice = count[group.ravel()] > 1
    covered = np.zeros(len(ids), dtype=bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= twice
    return int(covered.sum())


def _measure(text: str) -> tuple[int, ...]:
    words = text.encode().split()  # bytes split at exactly the white space of SPACES
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        _repeated(ids),
    )


def measure(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements) of every row, from its whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [_measure(t) for t in texts(batch)]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], ["doc_id", *MEASURES]
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = ", ".join(f"{c} long" for c in ("doc_id", *MEASURES))
    return source.mapInArrow(run, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus `failed_bits`: one bit per rule that the document fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
            for i, rule in enumerate(RULES.values())]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed_bits", failed)


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def rejected(policy: str) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablation(entries: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and kept without it.

    The ledger shrinks to one row per distinct set of bits (at most 2 ** rules) before the rules
    are laid beside it, so the size of the corpus does not matter after one counting pass.
    """
    whole = mask(policy)
    sets = entries.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("docs"))
    rules = F.explode(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.lit(1 << list(RULES).index(name)).cast("long")
                 .alias("bit")) for name in POLICIES[policy]
    ]))
    failing = F.col("failed_bits").bitwiseAND(F.lit(whole).cast("long"))
    docs = F.col("docs")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, docs).otherwise(F.lit(0)))

    return (
        sets.select("docs", failing.alias("failing"), rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            total(F.col("failing").bitwiseAND(F.col("r.bit")) != 0).alias("n_failed"),
            total(F.col("failing") == F.col("r.bit")).alias("n_failed_alone"),
            total(F.col("failing").bitwiseAND(F.bitwise_not(F.col("r.bit"))) == 0)
            .alias("n_kept_without"),
        )
    )


def corpus_bits(entries: DataFrame) -> DataFrame:
    """One row: bits that some document fails, that all fail, and the number of documents."""
    return entries.agg(
        F.bit_or("failed_bits").alias("any_bits"), F.bit_and("failed_bits").alias("all_bits"),
        F.count(F.lit(1)).alias("docs"),
    )


def judge(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The ledger with `base_failed` and the policy's verdict `kept`."""
    return ledger(docs).select(
        "*", rejected("base").alias("base_failed"),
        (~rejected("base") & ~rejected(policy)).alias("kept"),
    )



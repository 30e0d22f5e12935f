"""The corpus operators as queries on the driver's tables, with SQL where it expresses them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    collocations,
    html_wrappers,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    sentence_pieces,
    simhash,
    spot_signatures,
    substring_dedup,
    toxicity,
    warc,
    whitening,
)
from kerbside.llm.common import table
from kerbside.llm.sql import COLLOCATIONS, LINE_DEDUP, QUALITY_RULES, SOURCE_MIXING

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
# Target weights of the mixture: the two web crawls are damped, curated sources count double.
# Sources without a weight share `OTHER_WEIGHT`.
WEIGHTS = {"src0": 4.0, "src1": 1.0, "src2": 1.0, "src3": 2.0, "src4": 2.0, "src5": 1.0}
OTHER_WEIGHT = 9.0


def register(name: str, sql: str | None = None):
    def wrap(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return wrap


@register("op1_quality_rules", QUALITY_RULES)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "failed_bits", "base_failed", "kept")


@register("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", "held_out", "score", "predicted")


@register("op4_line_dedup", LINE_DEDUP)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
                       F.sha2("kept", 256).alias("kept_sha256"))


@register("op5_source_mixing", SOURCE_MIXING.format(
    weights=", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items()), others=OTHER_WEIGHT))
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, WEIGHTS, OTHER_WEIGHT).select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"),
        F.col("copy").cast("long").alias("copy"))


@register("op6_best_fit_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@register("op7_substring_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op8_warc")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op9_spot_signatures")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As many ranges as two for each partition of a shuffle.
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spot_signatures.spot_fingerprints(table(spark, sf_dir, "documents"), ranges)
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "n_signatures",
        "length_partition", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@register("op10_html_wrappers")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.main_texts(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register("op11_whitening")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op12_collocations", COLLOCATIONS)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@register("op13_sentence_pieces")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sentence_pieces.encode_and_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"), "verified")

"""Registered corpus queries on the smallest tables, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from compare import compare, duck
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from kerbside.llm import queries as Q
from kerbside.llm import near_copies, simhash, toxicity
from kerbside.llm.common import table


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_matches_sql(spark, name):
    assert compare(spark, duck(SF), Q.QUERIES[name], Q.ORACLE[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE)))
def test_query_covers_its_table(spark, name):
    got = Q.QUERIES[name](spark, SF)
    tables = {"page_id": "pages", "vec_id": "embeddings", "doc_id": "documents"}
    key = next(k for k in tables if k in got.columns)
    source = table(spark, SF, tables[key])
    assert {r[0] for r in got.select(key).collect()} == {
        r[0] for r in source.select(key).collect()}


def brute_near_copies(rows):
    """The least id that each id reaches, over 5-word shingles at a similarity of 0.8 or more."""
    from test_corpus_operators import brute_components

    grams = {}
    for i, text in rows:
        found = (text or "").encode().lower().split()
        grams[i] = {tuple(found[k : k + 5]) for k in range(max(len(found) - 4, bool(found)))}

    def near(a, b):
        x, y = grams[a], grams[b]
        small, large = sorted((len(x), len(y)))
        return 5 * small >= 4 * large and 5 * len(x & y) >= 4 * len(x | y)

    return brute_components(sorted(grams), near)


def test_stages_of_the_pipeline(spark, tmp_path):
    docs = before = table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    ids = {k: Counter(r[0] for r in v.select("doc_id").collect()) for k, v in seen.items()}
    model = toxicity.fit(before, table(spark, SF, "labels"))
    clean = toxicity.score_documents(before, model).where("predicted = 0")
    assert ids["toxicity"] == Counter(r[0] for r in clean.select("doc_id").collect())
    assert ids["line_dedup"] == ids["toxicity"]
    grouped = brute_near_copies([(r.doc_id, r.text) for r in seen["line_dedup"].collect()])
    assert ids["simhash"] == Counter(set(grouped.values()))
    assert set(ids["source_mixing"]) <= set(ids["simhash"])
    places = defaultdict(list)
    for r in seen["best_fit_packing"].collect():
        places[r.sequence_id].append((r.offset, r.length))
    assert all(max(o + n for o, n in s) == sum(n for _, n in s) <= 2048 for s in places.values())
    assert ids["best_fit_packing"].keys() == ids["source_mixing"].keys()


def test_pipeline_of_awkward_rows(spark, tmp_path):
    from test_corpus_operators import DOCS, ROWS, padded

    for k, rows in enumerate(([], padded(ROWS, 16))):
        docs = spark.createDataFrame(rows, DOCS)
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{k}/{name}")
        assert (docs.count() > 0) == bool(rows)
    assert docs.where(F.col("offset") < 0).count() == 0


def test_simhash_stage_keeps_one_of_each_group_at_jaccard_080(spark):
    """Against brute force over 5-word shingles, rows without an id aside."""
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    base = [f"w{n * n % 1009}" for n in range(200)]
    for k in range(60):  # near copies with two to seven changed words, at 0.7 to 0.9
        text = list(base)
        for n in range(k % 6 + 2):
            text[(17 * k + 29 * n) % 200] = f"x{k}y{n}"
        rows.append((1_000_000 + k, " ".join(text)))
    rows += [(2_000_000, ""), (2_000_001, None), (2_000_002, "a b"), (2_000_003, "A  b")]
    want = set(brute_near_copies(rows).values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for block, common in ((2_048, 100_000), (8, 0)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(near_copies, "BLOCK", block)
            patch.setattr(near_copies, "COMMON", common)
            patch.setattr(near_copies, "SAMPLE", 1)
            got = corpus_pipeline.simhash_stage(spark, docs, SF)
            assert {r.doc_id for r in got.collect()} == want
    old = simhash.near_duplicates(docs).where("doc_id = component_id").count()
    assert len(want) < old  # the 3-bit links of op2 leave near copies


def test_simhash_stage_joins_what_simhash_links(spark):
    """Fingerprints at three bits or fewer link, whatever the share of 5-word shingles."""
    # Three shingles found hundreds of times decide every bit; most of the set differs.
    rows = [(i, "a b c " * 300 + " ".join(f"x{i}y{n}" for n in range(30))) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    linked = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 3, 3).collect()}
    jaccard = set(brute_near_copies(rows).values())
    got = {r.doc_id for r in corpus_pipeline.simhash_stage(spark, docs, SF).collect()}
    assert len(jaccard) > len(set(linked.values())) and got == set(linked.values())


def test_few_pairs_of_texts_that_share_a_part_are_formed(spark, monkeypatch):
    """Texts of one template stay apart, and their pairs do not grow with the square of its use."""
    formed, settled = [], near_copies.settled

    def counted(df, name, *consumed):
        stored = settled(df, name, *consumed)
        if name == "pairs":
            formed.append(stored.count())
        return stored

    monkeypatch.setattr(near_copies, "settled", counted)
    template = " ".join(f"t{n * n % 1009}" for n in range(100))
    rows = [(i, template + " " + " ".join(f"x{i}y{n}" for n in range(60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.simhash_stage(spark, docs, SF)
    linked = simhash.near_duplicates(docs).select("component_id").distinct()
    assert got.count() == linked.count()
    assert sum(formed) < 2_000  # 19,900 pairs in all

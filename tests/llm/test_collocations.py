"""Collocations against brute force, with colliding fingerprints and on awkward rows."""

from __future__ import annotations

import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF

from kerbside.llm import collocations
from kerbside.llm.common import BATCH_BYTES, table

DOCS = "doc_id long, text string, lang string, phrase string, f long, size int, place int"


def brute(rows, longest=3, least=10, top=2000, share=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, *w[i : i + k]) for i in range(len(w) - k + 1))
    candidates = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    gone = {
        (k[0], *k[i : i + m]) for k, v in candidates.items() for m in range(2, len(k) - 1)
        for i in range(1, len(k) - m + 1) if 100 * v >= share * f[(k[0], *k[i : i + m])]}
    out = {}
    for k, a in candidates.items():
        if k not in gone:
            cuts = []
            for c in range(1, len(k) - 1):
                left, right = f[k[: 1 + c]], f[(k[0], *k[1 + c :])]
                cuts.append((1_000_000 * a * a // (left * right), c, left, right))
            score, _, left, right = min(cuts)
            out.setdefault(k[0], []).append((-score, -a, " ".join(k[1:]).encode(), left, right))
    return {(g, i + 1, p.decode(), -a, left, right, n[g], -s) for g, v in out.items()
            for i, (s, a, p, left, right) in enumerate(sorted(v)[:top])}


def rows_of(spark, rows):
    return spark.createDataFrame(
        [(i, t, g, "x", 0, 0, 0) for i, (g, t) in enumerate(rows)], DOCS).repartition(3)


ROWS = [
    *[("en", "New York is big. New York, new YORK city hall\nin New York")] * 6,
    *[(None, "a b c\x0ba b c; a b")] * 12,
    ("en", None), ("en", ""), ("de", "  \t "), ("fr", "..,;!?"), ("en", "x\x01 x\x01\x85y ÄÖ äö"),
    ("de", " ".join(["immer", "wieder", "und"] * 700)), ("", "tie one tie two " * 20),
    ("zz", "\x00 \x00 \x00\t\x00 " * 10), ("en", "word" * 50_000),
]


def test_awkward_rows(spark):
    found = {tuple(r) for r in collocations.collocations(rows_of(spark, ROWS)).collect()}
    assert found == brute(ROWS) and len(found) == 10


@pytest.mark.parametrize("longest,top,share", [(4, 5, 80), (2, 3, 50)])
def test_longer_phrases(spark, longest, top, share):
    found = collocations.collocations(rows_of(spark, ROWS), longest, 5, top, share)
    assert {tuple(r) for r in found.collect()} == brute(ROWS, longest, 5, top, share)


def test_no_rows(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert collocations.collocations(rows_of(spark, [("en", None)])).collect() == []


def test_colliding_fingerprints_are_counted_again(spark):
    rows = [(r.lang, r.text) for r in table(spark, SF, "documents").collect()]
    found = collocations.collocations(rows_of(spark, rows), bits=9)
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_many_flushes_and_large_counts(spark):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(collocations, "HELD", 50)
        patch.setattr(collocations, "CACHED", 5)
        rows = [*ROWS, ("en", "far away " * 3_000)]
        found = collocations.collocations(rows_of(spark, rows))
        assert {tuple(r) for r in found.collect()} == brute(rows)


def test_entries_go_before_texts_are_read_again(spark, monkeypatch):
    """The packed entries are the largest shuffle; its files must not lie beside the next one."""
    written, settled = [], collocations.settled

    def note(df, name, *consumed):
        written.append(name)
        return settled(df, name, *consumed)

    monkeypatch.setattr(collocations, "settled", note)
    docs = spark.createDataFrame([(i, "a b c. a b", "en") for i in range(12)],
                                 "doc_id long, text string, lang string")
    counts, _ = collocations.phrase_counts(docs)
    assert written[:2] == ["fingerprints", "phrases"]
    assert {(r.phrase, r.f) for r in counts.where("size = 2").collect()} == {
        ("a b", 24), ("b c", 12)}


def test_a_task_counts_in_little_memory():
    """Workers keep what they once held, so two of them must fit beside the heap of an executor."""
    class Source:
        def mapInArrow(self, run, schema):
            return run

    rng = np.random.default_rng(1)
    lines = [" ".join(map(str, rng.integers(0, 400_000, 1_000).tolist())) for _ in range(2_000)]
    batches = [pa.record_batch([pa.array(["en"] * 400), pa.array(lines[i : i + 400]),
                                pa.array(range(i, i + 400))], ["lang", "text", "place"])
               for i in range(0, len(lines), 400)]
    run = collocations._packed_counts(Source(), 0, 3, 10, 64)
    entries = 0
    tracemalloc.start()
    try:
        for packed in run(iter(batches)):
            entries += sum(map(len, packed.column("counts").to_pylist()))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert entries > 4_000_000  # more than a task holds
    assert most < 250_000_000


def test_python_gets_small_batches(spark, monkeypatch):
    limits, settled = [], collocations.settled

    def note(df, name, *consumed):
        limits.append(spark.conf.get(BATCH_BYTES, None))
        return settled(df, name, *consumed)

    monkeypatch.setattr(collocations, "settled", note)
    before = spark.conf.get(BATCH_BYTES, None)
    collocations.phrase_counts(rows_of(spark, ROWS))
    assert limits == [str(collocations.RECEIVED)] * 2
    assert spark.conf.get(BATCH_BYTES, None) == before

"""Corpus operators against brute force on small fixtures, and on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from kerbside.llm import (
    html_wrappers,
    line_dedup,
    mixing,
    packing,
    quality_rules,
    simhash,
    spot_signatures,
    substring_dedup,
    toxicity,
    warc,
)
from kerbside.llm.components import components

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# Extra columns carry names that the operators use inside.
DOCS = ("doc_id long, text string, lang string, source string, n_chars long, fp long, "
        "key string, `row` string, h1 long, bucket string, weight double, `range` int, "
        "fingerprint string, anchors array<long>, gone string, kept boolean")
PAGES = "page_id long, url string, html string, host string, payload binary, sha1 string"


def words(*numbers: int) -> str:
    return " ".join(f"w{n}" for n in numbers)


SHARED = words(*range(60))
LONG = words(*(n % 977 for n in range(9_000)))
LINE = "A line that several documents share, Ünd mehr"
ROWS = [
    (1, "", "en", "src0"),
    (2, None, None, None),
    (3, "  \t\n \r\n", "en", "src1"),
    (4, "one", "en", "src0"),
    (5, f"{SHARED} {words(*range(100, 130))}", "en", "src0"),
    (6, f"{words(*range(200, 215))} {SHARED} {words(*range(300, 310))}", "en", "src9"),
    (7, f"{SHARED} {words(*range(100, 130))}", "en", "src0"),  # equal to 5
    (8, f"{SHARED} {words(*range(100, 130))}", "de", "src0"),
    (8, f"{SHARED} {words(*range(100, 130))}", "de", "src0"),  # a repeated row
    (9, f"{LINE}\nown line of nine, long enough\n\n {LINE.upper()} ", "en", "src2"),
    (10, f"{LINE}\nshort\n{LINE}", "en", "src2"),
    (11, f"\t{LINE}\nshort", "en", "src2"),
    (12, LONG, "en", "src3"),
    (None, f"{LINE}\n{SHARED}", "en", "src4"),
    (13, "<|endoftext|> a  b   c\x00d 😀 é", "en", "src5"),
    (14, words(*[1, 2, 3] * 30), "en", "src5"),
    (15, f"{LONG} the end", "en", "src3"),
    (-3, "The cat of the house sat on a mat and the dog of the yard ran to the gate.", "en", ""),
]


def padded(rows, width):
    return [(*r, *[None] * (width - len(r))) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(padded(ROWS, 16), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# ---- quality rules -----------------------------------------------------------------


def brute_measures(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    found = text.encode().split()
    windows = list(zip(found, found[1:], found[2:], strict=False))
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(spaces)]
    return (len(found), sum(len(w.decode()) for w in found),
            sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)),
            len(covered))


def test_measures(docs, empty):
    want = Counter((r[0], *brute_measures(r[1])) for r in ROWS)
    assert pairs(quality_rules.measure(docs), "doc_id", *quality_rules.MEASURES) == want
    assert quality_rules.judge(empty).count() == 0


def test_wide_vocabulary_counts_windows_exactly():
    import numpy as np

    ids = np.array([0, 1, 2_500_000, 0, 1, 2_500_000, 7], dtype=np.int64)
    assert quality_rules._repeated(ids) == 6


def test_ablation_reads_the_ledger(docs):
    rows = [r.failed_bits for r in quality_rules.ledger(docs).select("failed_bits").collect()]
    names = list(quality_rules.RULES)
    for policy, rules in quality_rules.POLICIES.items():
        whole = quality_rules.mask(policy)
        got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without)
               for r in quality_rules.ablation(quality_rules.ledger(docs), policy).collect()}
        assert set(got) == set(rules)
        for rule in rules:
            bit = 1 << names.index(rule)
            assert got[rule] == (
                sum(b & bit > 0 for b in rows), sum(b & whole == bit for b in rows),
                sum(b & whole & ~bit == 0 for b in rows))
    union = quality_rules.corpus_bits(quality_rules.ledger(docs)).first()
    assert union.docs == len(ROWS)
    assert quality_rules.corpus_bits(quality_rules.ledger(docs.limit(0))).first().docs == 0


# ---- SimHash -----------------------------------------------------------------------


def brute_fingerprint(text):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    grams = ([b" ".join(found[i : i + 3]) for i in range(len(found) - 2)]
             or [b" ".join(found)])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(docs, empty):
    fps = [(i, brute_fingerprint(t)) for i, t, *_ in ROWS]
    group = brute_components(sorted({f for _, f in fps}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = defaultdict(list)
    for i, f in fps:
        least[group[f]].append(i)
    want = Counter(
        (i, f"{f:016x}", min((x for x in least[group[f]] if x is not None), default=None))
        for i, f in fps)
    assert pairs(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [2_048, 8])
def test_links_keep_every_component(spark, monkeypatch, block):
    """Dense balls and chains of fingerprints; small blocks force the path of large buckets."""
    import random

    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(5)
    values = {0, 2**64 - 1}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(60):
            value = centre
            for _ in range(rng.randint(0, 3)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
        for _ in range(20):
            value ^= 1 << rng.randrange(64) | 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(value)
    nodes = sorted(v - (v >> 63 << 64) for v in values)
    want = brute_components(nodes, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    links = simhash.links(spark.createDataFrame([(v,) for v in nodes], "fp long"))
    found = {r.node: r.root for r in components(links).collect()}
    assert {n: found.get(n, n) for n in nodes} == want


def test_chain_budgets_lose_no_close_pair():
    import random

    import numpy as np

    rng = random.Random(3)
    close = [sum(1 << b for b in rng.sample(range(64), k)) for k in range(4) for _ in range(500)]
    assert simhash._within_budget(np.array(close, dtype=np.uint64), 3).all()
    assert not simhash._within_budget(np.array([2**64 - 1], dtype=np.uint64), 3).any()


def test_components_of_a_long_chain(spark):
    links = spark.range(40).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


# ---- lines -------------------------------------------------------------------------


def brute_lines(rows):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)

    held = defaultdict(set)
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 20:
                held[key(line)].add(i)
    out = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(held[key(x)]) < 3 or max(held[key(x)]) == i]
        out[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return out


def test_line_dedup(docs, empty):
    got = line_dedup.drop_shared_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept")
    assert Counter(map(tuple, got.collect())) == brute_lines(ROWS)
    assert line_dedup.drop_shared_lines(empty).count() == 0


def test_bitmaps_beyond_one_word(spark):
    rows = [(i, "\n".join(f"line number {n} of the long ones" for n in range(0, 200, i)))
            for i in (1, 2, 3, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.drop_shared_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept")
    assert Counter(map(tuple, got.collect())) == brute_lines(rows)


def test_lines_are_dealt_by_ranges(docs):
    plan = line_dedup.shared_lines(line_dedup.line_hashes(docs))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in text and "Python" not in text and "Arrow" not in text


# ---- mixing ------------------------------------------------------------------------


def test_mixing_meets_its_rates(spark, empty):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "IF(id % 4 = 0, 'a', IF(id % 4 = 1, 'b', 'c')) AS source", "id AS copy")
    mixed = mixing.mix(docs, {"a": 2.0, "b": 0.0}, others=1.0)
    count = {r[0]: r[1] for r in mixed.groupBy("row.source").count().collect()}
    assert "b" not in count
    assert abs(count["a"] / 20_000 - 2 / 3) < 0.03 and abs(count["c"] / 20_000 - 1 / 3) < 0.02
    again = mixing.mix(docs.repartition(5), {"a": 2.0, "b": 0.0}, others=1.0)
    assert pairs(mixed, "row.doc_id", "copy") == pairs(again, "row.doc_id", "copy")
    assert mixing.mix(empty, {"a": 1.0}).count() == 0


def test_large_rates_do_not_vanish(spark):
    docs = spark.createDataFrame([(i, "few" if i < 5 else "x") for i in range(5_000)],
                                 "doc_id long, source string")
    got = mixing.mix(docs, {"few": 1.0}, others=0.0).count()  # a mean of 1000 copies each
    assert abs(got - 5_000) < 400


def test_mixing_of_awkward_rows(docs):
    got = mixing.mix(docs, {"src0": 1.0}, others=2.0, size=3.0)
    assert {r.id for r in got.select(F.col("row.doc_id").alias("id")).collect()} <= {
        r[0] for r in ROWS}
    with pytest.raises(ValueError):
        mixing.rates(docs, {"src0": -1.0}, 1.0, 1.0)


# ---- packing -----------------------------------------------------------------------


def test_packing_is_a_gapless_round_trip(docs, empty):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(TOKENIZER)
    got = packing.best_fit(docs, TOKENIZER).collect()
    want = Counter()
    for i, t, *_ in ROWS:
        ids = [*exact.encode(t or "", add_special_tokens=False).ids, 0]
        at = number = 0
        while at < len(ids):
            size = (len(ids) - at) % 2048 or 2048
            part = b"".join(x.to_bytes(4, "little") for x in ids[at : at + size])
            want[(i, number, at, size, zlib.crc32(part))] += 1
            at, number = at + size, number + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.best_fit(empty, TOKENIZER).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece(seed):
    import random

    rng = random.Random(seed)
    counts = Counter(min(100, max(1, int(rng.expovariate(0.04)))) for _ in range(3_000))
    rows = packing.plan(dict(counts), 100)
    bins, placed = defaultdict(list), Counter()
    for length, rank, count, each, sequence, offset in rows.tolist():
        for k in range(count):
            placed[(length, rank + k)] += 1
            bins[sequence + k // each].append((offset + k % each * length, length))
    assert placed == Counter({(n, k): 1 for n, c in counts.items() for k in range(c)})
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 100 and sum(3 * n > 100 for _, n in spans) <= 2
    tokens = sum(n * c for n, c in counts.items())
    assert len(bins) <= 1.01 * -(-tokens // 100) + 1


# ---- passages ----------------------------------------------------------------------


def brute_passages(rows, width=50):
    first = {}
    for i, t, *_ in rows:
        found = (t or "").encode().split()
        for k in range(len(found) - width + 1):
            w = tuple(found[k : k + width])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = Counter()
    for i, t, *_ in rows:
        found = (t or "").encode().split()
        gone = set()
        for k in range(len(found) - width + 1):
            if i is not None and first[tuple(found[k : k + width])] < i:
                gone.update(range(k, k + width))
        kept = b" ".join(w for k, w in enumerate(found) if k not in gone).decode()
        out[(i, len(found), len(gone), kept)] += 1
    return out


def test_passages(docs, empty):
    got = substring_dedup.remove_repeats(docs)
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept") == brute_passages(ROWS)
    for r in got.collect():
        assert sum(s.end - s.start for s in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:], strict=False))
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_passages_of_random_documents(spark):
    import random

    rng = random.Random(1)
    blocks = [[f"t{rng.randrange(300)}" for _ in range(rng.randint(30, 90))] for _ in range(12)]
    rows = []
    for i in range(40):
        text = [f"d{i}x{k}" for k in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 4)):
            text += rng.choice(blocks) + [f"t{rng.randrange(300)}"]
        rows.append((i, " ".join(text)))
    got = substring_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept") == brute_passages(rows)


# ---- WARC --------------------------------------------------------------------------

PAGE_ROWS = [
    (1, "http://a.example/x", "<p>one</p>"), (2, "http://a.example/y", "<p>one</p>"),
    (3, None, None), (4, "", ""), (5, "http://b.example/\r\nz", "é" * 3_000_000),
    (6, "http://b.example/q", "a\r\n\r\nb\r\n\r\n"), (6, "http://b.example/q", "a\r\n\r\nb\r\n\r\n"),
    (None, "http://b.example/q", "<p>one</p>"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(padded(PAGE_ROWS, 6), PAGES).repartition(2)


def test_archives_round_trip(spark, pages):
    last = {}
    for i, _, h in PAGE_ROWS:
        if i is not None:
            last[h or ""] = max(last.get(h or "", i), i)
    want = Counter()
    for i, _, h in PAGE_ROWS:
        data = (h or "").encode()
        to = last[h or ""] if i is not None and i < last[h or ""] else None
        want[(i, len(data), warc.digest(data), "revisit" if to else "response", to)] += 1
    got = warc.archive_pages(pages)
    assert pairs(got, "page_id", "payload_bytes", "payload_digest", "record_type",
                 "refers_to") == want
    bodies = {r.page_id: bytes(r.payload).decode() for r in got.where("payload is not null")
              .collect()}
    assert bodies[5] == "é" * 3_000_000 and bodies[6] == "a\r\n\r\nb\r\n\r\n"
    assert warc.archive_pages(spark.createDataFrame([], PAGES)).count() == 0


def test_reader_takes_bytes_in_any_portions_and_files(spark, tmp_path):
    data = b"".join(
        warc.write_record(i, f"http://x/{i}", b"p" * i, warc.digest(b"p" * i), None)
        for i in range(50))
    for step in (1, 7, 4_096):
        reader, seen = warc.SequentialReader(), []
        for at in range(0, len(data), step):
            seen += [warc.parse(*r) for r in reader.feed(data[at : at + step])]
        reader.close()
        assert [(r[0], r[6]) for r in seen] == [(i, b"p" * i) for i in range(50)]
    (tmp_path / "a.warc.gz").write_bytes(data)
    assert warc.read_files(spark, str(tmp_path)).count() == 50


def test_reader_refuses_broken_archives():
    good = warc.write_record(1, "u", b"body", warc.digest(b"body"), None)
    reader = warc.SequentialReader()
    assert not list(reader.feed(good[:-5]))
    with pytest.raises(ValueError):
        reader.close()
    wrong = warc.write_record(1, "u", b"body", warc.digest(b"other"), None)
    with pytest.raises(ValueError):
        [warc.parse(*r) for r in warc.SequentialReader().feed(wrong)]


# ---- spot signatures ---------------------------------------------------------------


def test_spot_fingerprints(docs, empty):
    import math

    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    got = spot_signatures.spot_fingerprints(docs, 4).collect()
    assert len(got) == len(ROWS)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_text = defaultdict(set)
    for r in got:
        text = next(t or "" for i, t, *_ in ROWS if i == r.doc_id)
        by_text[text].add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    edits = Counter((r.doc_id, r.edited_text) for r in got)
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = math.floor(len(t) / 4)
        assert edits[(i, t[: len(t) - n] + after[:n])], i
    assert spot_signatures.spot_fingerprints(empty, 4).count() == 0


def test_likeness_is_jaccard_of_the_fingerprints(docs):
    for r in spot_signatures.spot_fingerprints(docs, 3).collect():
        a, b = ({f[k : k + 16] for k in range(0, len(f), 16)}
                for f in (r.fingerprint, r.edited_fingerprint))
        want = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r.near_edited - want) < 1e-12


def test_signatures_are_chains_after_common_words(spark):
    text = "alpha beta of the gamma delta, and epsilon " + "x" * 400
    got = spark.createDataFrame([(text,)], "t string").select(
        spot_signatures.signatures(F.col("t")).alias("s")).first().s
    chains = [("alpha", "beta"), ("beta", "gamma"), ("the", "gamma", "delta"),
              ("and", "epsilon", "x" * 400)]
    want = {spark.range(1).select(F.xxhash64(*map(F.lit, c)).alias("h")).first().h for c in chains}
    assert want <= set(got) and got == sorted(got)


def test_one_rule_on_either_side_of_400_characters(spark):
    text = " ".join(f"the word{n:03d}" for n in range(40))  # 479 characters
    rows = [(text[:k],) for k in (399, 401, 431, 311)]
    a, b, c, d = (r.s for r in spark.createDataFrame(rows, "t string").select(
        spot_signatures.signatures(F.col("t")).alias("s")).collect())
    for x, y, least in ((a, b, 0.9), (c, d, 0.6)):
        assert len(set(x) & set(y)) / len(set(x) | set(y)) > least


def test_fingerprints_run_no_python(docs):
    plan = spot_signatures.spot_fingerprints(docs, 3)._jdf.queryExecution().executedPlan()
    assert "Python" not in plan.toString() and "Arrow" not in plan.toString()


# ---- toxicity ----------------------------------------------------------------------


def test_folding():
    assert toxicity.fold("1d10t, STUP1D $cum!  2024 mоrоn") == " idiot stupid scum moron "


def test_matcher_equals_naive_search():
    model = toxicity.Model({" bad ": 2.0, " awf": 1.5, " worse": 3.0}, ("bad luck",), None)
    matcher = toxicity.Matcher(model)
    assert matcher.measure("Bad b4d luck awful AWFUL worsening badly bad") == (10.0, 8)
    assert matcher.measure("") == (0.0, 0)
    assert toxicity.Matcher(toxicity.Model({}, (), None)).measure("bad") == (0.0, 1)


def test_learned_words_score_held_out_documents(spark):
    import random

    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1_500):
        toxic = rng.random() < 0.2
        text = [f"w{rng.choice('abcdefgh')}{rng.choice('klmnop')}o" for _ in range(60)]
        if toxic:
            text[rng.randrange(60)] = rng.choice(["rotten", "v1lest", "grimyx", "grimyz"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(
        [*labels, (None, 1), (5_000, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    assert {" rotten ", " vilest "} <= set(model.weights)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    assert all(got[i].predicted == t for i, t in labels)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_toxicity_of_awkward_rows(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert {r.score for r in toxicity.score_documents(docs, model).collect()} == {0.0}
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.keep_clean(docs, model).count() == len(ROWS)
    assert toxicity.score_documents(empty, toxicity.fit(empty, none)).count() == 0


# ---- pages -------------------------------------------------------------------------

TEMPLATE = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{}</style>
<script>var a = "<p>no</p>";</script></head><body><header><h2>Site</h2></header>
<nav><ul><li><a href="/a">A</a><li><a>B</a></ul></nav><div class="cookie-notice">We use</div>
<article><h1>%s</h1>%s<aside>more</aside><form><p>mail</p></form>
<section id="comments"><p>first!</p></section></article>
<div id="sideBar"><p>side</p></div><footer>&copy;</footer></body></html>"""


def test_main_text(spark):
    bodies = [
        ("One", "<p>a <b>bold</b>&nbsp; word<p>next\n para<br>here", "One\na bold word\nnext para here"),
        ("Two &lt;3", "<ul><li>x<li>y</ul><p>z</p>", "Two <3\nx\ny\nz"),
        ("", "<table><tr><td>1<td>2</table>tail <i>it</i> <i>is</i>", "1 2\ntail it is"),
        ("Q", '<p title="a > b">quoted</p><p title=it\'s>apostrophe</p>', "Q\nquoted\napostrophe"),
    ]
    rows = [(i, "http://h.example/p", TEMPLATE % (h, b)) for i, (h, b, _) in enumerate(bodies)]
    rows += [(10, "http://h.example/none", None), (11, None, ""),
             (12, "http://h.example/cut", "<html><body><article><p>cut <b>off"),
             (13, "http://k.example/", "<div><div><p>no article</p><p>here</p></div></div>"),
             (14, "nonsense", "a < b & c > d"), (14, "nonsense", "a < b & c > d"),
             (15, "http://deep.example", "<div>" * 3_000 + "deep" + "</div>" * 3_000)]
    pages = spark.createDataFrame(padded(rows, 6), PAGES).repartition(2)
    got = {(r.page_id): r.text for r in html_wrappers.main_texts(pages).collect()}
    for i, (_, _, want) in enumerate(bodies):
        assert got[i] == want
    assert (got[10], got[11], got[12], got[13]) == ("", "", "cut off", "no article\nhere")
    assert got[14] == "a < b & c > d" and got[15] == "deep"
    assert html_wrappers.main_texts(pages.limit(0)).count() == 0


def test_wrappers_generalise_by_alignment(spark):
    def page(*items, ad=False):
        inner = "".join(f"<li>{x}</li>" for x in items)
        return f"<body><h1>News</h1>{'<p>ad</p>' if ad else ''}<ul>{inner}</ul></body>"

    rows = [(1, "http://x/1", page("a")), (2, "http://x/2", page("b", "c")),
            (3, "http://x/3", page("d", ad=True))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = html_wrappers.wrappers(pages).collect()
    assert [r.host for r in found] == ["x"]
    assert found[0].wrapper == (
        '<body> <h1> "News" </h1> ( <p> "ad" </p> )? <ul> ( <li> # </li> )+ </ul> </body>')


def extracted(*pages):
    """The main texts of pages of one host, without Spark."""
    from functools import reduce

    trees = [html_wrappers.fold(html_wrappers.parse(p)) for p in pages]
    whole = reduce(html_wrappers._merge, trees)
    found = (html_wrappers.regions(whole), html_wrappers.unconfirmed(whole),
             html_wrappers.constants(whole))
    return [html_wrappers.extract(p, *found) for p in pages]


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'data-hidden="false"', 'data-id="share-12"', 'class="no-sidebar"',
    'class="has-sidebar"', 'class="article-with-comments"', 'class="content-search-result"',
])
def test_names_that_only_look_like_an_aside(attributes):
    assert extracted(f"<body><div {attributes}><p>text</p></div></body>") == ["text"]
    assert extracted(f"<body {attributes}><p>text</p></body>") == ["text"]
    assert extracted(f"<div hidden><p>no</p></div><div {attributes}><p>text</p></div>") == ["text"]


def test_names_are_confirmed_by_the_host():
    page = '<body class="sidebar"><div class="widget"><article><p>{}</p></article></div></body>'
    assert extracted(page.format("a"), page.format("b")) == ["a", "b"]
    page = '<body><article><p>{0}</p><div class="notice"><p>{1}</p></div></article></body>'
    assert extracted(page.format("a", "same"), page.format("b", "same")) == ["a", "b"]
    assert extracted(page.format("a", "own"), page.format("b", "other")) == ["a\nown", "b\nother"]


@pytest.mark.parametrize("deep", [10, 199, 200, 201, 1_000, 20_000])
def test_text_after_deep_blocks_inside_an_article(deep):
    inside = "<div>" * deep + "<p>foo</p><p>bar</p>x<br>y" + "</div>" * deep
    page = f"<div><article><p>one</p>{inside}<p>two</p></article><p>not main</p></div>"
    assert extracted(page) == ["one\nfoo\nbar\nx y\ntwo"]
    hidden = "<div>" * deep + "<div hidden><p>no</p></div>yes" + "</div>" * deep
    assert extracted(f"<article>{hidden}<p>two</p></article>") == ["yes\ntwo"]


def test_slots_and_optional_parts_of_all_regions_are_read():
    page = ('<body><p>Our host greets you</p><div class="lead"><p>{0} lead</p></div><div class="b">'
            '<p>{1}</p></div><div class="second"><p>{0} second</p>{2}</div></body>')
    long = ["long " * 200 + x for x in "abc"]
    pages = [page.format(x, t, "<i>more</i>" if x == "C" else "")
             for x, t in zip("ABC", long, strict=True)]
    assert extracted(*pages) == [
        f"{x} lead\n{t}\n{x} second" + ("\nmore" if x == "C" else "")
        for x, t in zip("ABC", long, strict=True)]
    # A lone page, and a page with nothing but what is constant, keep their text.
    assert extracted(pages[0])[0].startswith("Our host greets you\nA lead\n")
    assert extracted("<p>same</p>", "<p>same</p><div>x</div>") == ["same", "x"]


def test_sha_of_kept_text_is_hex(docs):
    got = line_dedup.drop_shared_lines(docs).select(
        F.sha2("kept", 256).alias("h"), "kept").first()
    assert got.h == hashlib.sha256(got.kept.encode()).hexdigest()

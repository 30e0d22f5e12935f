"""Sentence pieces against the library: whole texts, random strings, random ids."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from conftest import SF

from kerbside.llm import sentence_pieces
from kerbside.llm.common import table

PATH = public_tokenizers.path("piece_bpe_32k.model")
with open(PATH, "rb") as file:
    MODEL = file.read()
ALPHABET = [*"abcdethein ▁▁  \n\t\x00<s>/0x1A>", "<s>", "</s>", "<unk>", "<0x0A>", "é", "中", "文",
            "😀", "�", "́", "​", "the", " ⁇ ", "\x0b", "ing", "1999"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=MODEL)


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_documents_like_the_library(spark, library):
    docs = table(spark, SF, "documents")
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    found = sentence_pieces.encode_and_decode(docs, PATH).collect()
    assert sorted(r.doc_id for r in found) == sorted(text)
    for r in found:
        ids = library.encode(text[r.doc_id], add_bos=True, add_eos=True)
        assert (r.ids, r.n_tokens, r.decoded) == (packed(ids), len(ids), library.decode(ids))
        assert r.verified


def test_random_strings_and_ids(library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(20_000)]
    texts += ["", " ", "▁", "a" * 300, "the " * 20 + "x" * 65, "中文" * 40_000, " " * 999]
    codec = sentence_pieces.Codec(MODEL, check=True)
    ids, right = codec.encode(texts)
    assert all(right)
    for text, mine in zip(texts, ids, strict=True):
        theirs = library.encode(text, add_bos=True, add_eos=True)
        assert mine == packed(theirs), text
        assert codec.decode(mine) == library.decode(theirs), text
    some = [0, 1, 2, 13, 259, 260, 261, *range(190, 259), 300, 29871]
    for _ in range(20_000):
        theirs = rng.choices(some, k=rng.randint(0, 8))
        assert codec.decode(packed(theirs)) == library.decode(theirs), theirs


def test_agendas_in_arrays_and_in_heaps_agree(library):
    words = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32_000, 7)]
    words += [a + b for a, b in zip(words, reversed(words), strict=True)]
    v = sentence_pieces.Vocabulary(MODEL)
    assert v.merge_many(words) == [v.packed(v.merge(w)) for w in words]


def test_a_wrong_stretch_is_noticed():
    codec = sentence_pieces.Codec(MODEL, check=True)
    v = codec.vocabulary
    codec._compare({" the": packed([278]), " cat": v.packed(v.merge(" cat"))})
    assert codec.odd == {" the"}
    assert codec.encode([" the cat", "cat"])[1][1]


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "w " * 200_000)]
    docs = spark.createDataFrame([(i, t, b"", "x") for i, t in rows],
                                 "doc_id long, text string, ids binary, decoded string")
    found = sentence_pieces.encode_and_decode(docs, PATH, check=False).collect()
    assert sorted((r.doc_id or 0, len(r.decoded)) for r in found) == sorted(
        (i or 0, len(t or "")) for i, t in rows)
    assert all(r.ids == packed([1, 2]) for r in found if r.doc_id in (1, 2))
    assert all(r.verified is None for r in found)
    empty = sentence_pieces.encode_and_decode(docs.limit(0), PATH)
    assert empty.collect() == []


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as proto

    spec = proto.ModelProto()
    spec.ParseFromString(MODEL)
    spec.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    with pytest.raises(ValueError, match="merge type"):
        sentence_pieces.Vocabulary(spec.SerializeToString())

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from helpers import EDGES, SF, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from busframes.llm import packing

TOK = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
ENC = packing.Encoder(open(P.path("byte_bpe_50k.json"), encoding="utf-8").read())


def ids(text):
    return TOK.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("a's tvrelmd' \n\t\r1½٣é漢字  \u0085\x1c.!<|>"), st.characters(codec="utf-8")), max_size=40), max_size=5))
def test_ids_equal_the_tokenizer(texts):
    got, offs = ENC.encode(pa.array(texts, pa.string()))
    assert [got[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])] == [ids(t) for t in texts]


@pytest.mark.parametrize("text", ["don't we'll I'd", " 's x's\n's 'tis ''s '", "a  b   \n\n c \n", "<|endoftext|> a <|endoftext|>", "x've'll'revere", "\n", "  ", "é'été l'eau"])
def test_hard_words(text):
    got, _ = ENC.encode(pa.array([text]))
    assert got.tolist() == ids(text)


def test_words_from_bytes_equal_the_tokenizer():
    """All words of the fixture, and random bytes of every kind of letter."""
    import random

    import pyarrow.parquet as pq

    rng = random.Random(7)
    texts = pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    texts += ["".join(rng.choice("aeinrst'-_éßжй漢字한🙂 1") for _ in range(rng.randrange(1, 90))) for _ in range(3000)]
    plain = packing.Encoder(open(P.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert plain.one is not None
    plain.one = None
    for i in range(0, len(texts), 500):
        a, b = ENC.encode(pa.array(texts[i:i + 500], pa.string())), plain.encode(pa.array(texts[i:i + 500], pa.string()))
        assert (a[0] == b[0]).all() and (a[1] == b[1]).all()


def test_words_beyond_the_kept_ones(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 20)
    for k in range(5):
        text = " ".join(f"word{i} of{k}" for i in range(30))
        assert ENC.encode(pa.array([text]))[0].tolist() == ids(text)


def check(rows, texts, capacity=2048):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for doc, text in texts.items():
        want, at = np.array([*ids(text), 1], "<u4"), 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at:at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padding = 0
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, sum(r.length for r in rows)


def test_pieces_of_the_fixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    padding, total = check(packing.query(spark, SF).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert padding < 0.02 * total


def test_awkward_documents(spark):
    texts = [*EDGES, "word " * 30000, "<|endoftext|>", None]
    check(packing.packed_digest(documents(spark, texts)).collect(), dict(enumerate(texts)))


def test_cuts_and_classes():
    for n in range(1, 6000):
        c = packing.cuts(n, 2048)
        assert sum(c) == n and all(0 < x <= 2048 for x in c)
        assert len([x for x in c if x < packing.LEAST_CUT]) <= 1
    p = packing.Packer(64, 3)
    for i in range(500):
        p.add(i, np.full(i % 150 + 1, i, "<u4"))
    p.close()
    t = p.take().to_pylist()
    assert sum(len(r["ids"]) // 4 for r in t) == sum(i % 150 + 1 for i in range(500)) and {r["sequence_id"] >> 33 for r in t} == {3}

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, EDGES, documents
from pyspark.sql import functions as F

from busframes.llm import suffix_repeats as S


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    count = {}
    for d in data:
        for p in range(len(d) - length + 1):
            count[d[p:p + length]] = count.get(d[p:p + length], 0) + 1
    out = []
    for d in data:
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if count[d[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        spans = len(bytes(gone).replace(b"\x00\x01", b"\x00S\x01").split(b"S")) - 1 + (1 if gone[:1] == b"\x01" else 0)
        out.append((len(d), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(d, gone) if not g)).hexdigest()))
    return out


def corpus(seed, n=60):
    r = random.Random(seed)
    letters = "abcdefgh éü\n"
    passage = ["".join(r.choice(letters) for _ in range(r.randrange(150, 700))) for _ in range(6)]
    out = list(EDGES)
    for _ in range(n):
        parts = []
        for _ in range(r.randrange(1, 5)):
            if r.random() < 0.5:
                p = r.choice(passage)
                a = r.randrange(len(p) // 2)
                parts.append(p[a:r.randrange(a, len(p))])
            else:
                parts.append("".join(r.choice(letters) for _ in range(r.randrange(300))))
        out.append("".join(parts))
    return [*out, "ab" * 400, out[-1], "z" * 199, "y" * 200, "x" * 201]


@pytest.mark.parametrize("group_bytes", [16 << 20, 1500])
def test_spans_against_brute_force(spark, monkeypatch, group_bytes):
    texts = corpus(11)
    docs = documents(spark, texts)
    full = S.repeat_spans
    monkeypatch.setattr(S, "repeat_spans", lambda d, length: full(d, length, group_bytes))
    rows = {r.doc_id: tuple(r)[1:] for r in S.removed(docs).collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts, 200)


def test_small_pieces_and_short_length(spark, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 1000)
    texts = corpus(4, 30)
    rows = {r.doc_id: tuple(r)[1:] for r in S.removed(documents(spark, texts), 64).collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts, 64)


def test_rolling_hashes_equal_exactly_for_equal_strings():
    r = np.random.default_rng(1)
    buf = r.integers(97, 99, 3000).astype(np.uint8)
    for width, h in zip((1, 7, 40, 200), S.rolling(buf, 1, 7, 40, 200)):
        seen = {}
        for i in range(len(buf) - width + 1):
            assert seen.setdefault(h[i], buf[i:i + width].tobytes()) == buf[i:i + width].tobytes()
        assert len(h) == len(buf) - width + 1 and len(seen) == len({buf[i:i + width].tobytes() for i in range(len(h))})


def test_maximal_repeat_groups_with_all_occurrences():
    regions = [b"xx" + b"A" * 5 + b"bcdefgh1", b"yy" + b"A" * 5 + b"bcdefgh2", b"zz" + b"A" * 5 + b"bcdefgh3", b"qqbcdefgh9"]
    groups = []
    region, start, size = S.suffix_cover(regions, 4, groups)
    covered = {(int(a), int(b)): int(c) for a, b, c in zip(region, start, size)}
    assert {(n, last - first + 1) for n, first, last in groups} >= {(12, 3), (7, 4)}
    assert covered[(0, 2)] == covered[(2, 2)] == 12 and covered[(3, 2)] == 7


def one_anchor(n, seed=2):
    """Regions with one middle and edges of their own."""
    r = np.random.default_rng(seed)
    middle, out = r.integers(97, 123, 279).astype(np.uint8), []
    for _ in range(n):
        x = r.integers(97, 123, 279).astype(np.uint8)
        a, b = r.integers(0, 30), 279 - r.integers(0, 30)
        x[a:b] = middle[a:b]
        out.append(x.tobytes())
    return out


def test_large_group_takes_memory_for_some_classes_at_a_time():
    regions = one_anchor(8000)
    size = sum(map(len, regions))
    tracemalloc.start()
    region, start, cover = S.suffix_cover(regions, 200)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(region) > 100_000 and cover.min() >= 200
    assert peak < 25 * size, f"{peak / size:.1f} bytes for each byte of the group"


def test_classes_at_a_time_find_the_same_groups(monkeypatch):
    regions = one_anchor(60) + ["ab".encode() * 130, b"x" + "ab".encode() * 130, b"short" * 40]
    groups, few = [], []
    whole = [x.tolist() for x in S.suffix_cover(regions, 200, groups)]
    monkeypatch.setattr(S, "TAILS", 500)
    monkeypatch.setattr(S, "PIECE", 700)
    assert [x.tolist() for x in S.suffix_cover(regions, 200, few)] == whole and len(whole[0]) > 500
    assert few == groups and len(groups) > 5
    assert [len(x) for x in S.suffix_cover([b"y" * 200, b"z" * 200], 200)] == [0, 0, 0]


def test_spans_of_rows_are_united_in_arrays():
    r = random.Random(3)
    rows = [None, [], [(0, 5)], [(5, 9), (0, 5)], [(3, 4), (0, 9), (1, 2)], None, *([(a, a + r.randrange(1, 9)) for a in r.sample(range(60), 8)] for _ in range(30)), [], [(7, 8)]]
    column = pa.array([None if x is None else [{"s": s, "e": e} for s, e in x] for x in rows], pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))
    assert all(s < e for x in S._merged(column) for s, e in x)
    for part, own in ((column, rows), (column.slice(3, 20), rows[3:23]), (column.slice(0, 2), rows[:2]), (column.slice(0, 0), [])):
        got = list(S._merged(part))
        assert len(got) == len(own)
        for spans, x in zip(got, own):
            covered = {i for s, e in x or [] for i in range(s, e)}
            assert {i for s, e in spans for i in range(s, e)} == covered
            assert all(e < s for (_, e), (s, _) in zip(spans, spans[1:]))


def test_stage_keeps_columns_and_characters(spark):
    shared = "é" * 120
    docs = spark.createDataFrame([(1, "a " + shared + "ô b", None, "s", 5), (2, shared + "î", "fr", None, None), (3, None, None, None, None), (4, "clean", "en", "s", 5)], DOCS)
    docs = docs.withColumn("rid", F.lit(7)).withColumn("spans", F.lit("own"))
    got = {r.doc_id: r for r in S.drop_repeats(spark, docs, "").collect()}
    assert got[1].text == "a ô b" and got[2].text == "î" and got[3].text is None and got[4].text == "clean"
    assert got[1].n_chars == 5 and got[1].rid == 7 and got[4].spans == "own" and set(got[1].asDict()) == set(docs.columns)

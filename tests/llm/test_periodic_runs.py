"""Baier grouping against plain definitions, and the query by brute force."""

import hashlib
import random
import zlib

import numpy as np
from helpers import DOCS, EDGES, SF, documents, saved
from hypothesis import given, settings
from hypothesis import strategies as st

from busframes.llm import bytesops as B
from busframes.llm import periodic_runs as P


def plain_lyndon(s):
    """Longest prefix of each suffix that is less than all its proper suffixes."""
    out = []
    for i in range(len(s)):
        j = i + 1
        while j < len(s) and not s[j:] < s[i:]:  # up to the next smaller suffix
            j += 1
        out.append(j - i)
    return out


def plain_runs(s, least):
    """By trying every period."""
    found, n = [], len(s)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if s[i] != s[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, 2 * q) and not any(p < q and a <= i and i + size <= a + l for a, l, p in found):
                found.append((i, size, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@given(st.lists(st.integers(0, 3), max_size=40))
@settings(max_examples=400, deadline=None)
def test_grouping_gives_both_lyndon_arrays(s):
    _, rank = np.unique(np.array(s, int), return_inverse=True)
    up = rank.tolist()
    assert P.lyndon_lengths(up) == plain_lyndon(up)
    down = [max(up) - x for x in up]
    assert P.lyndon_lengths(down) == plain_lyndon(down)


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=4), st.sampled_from([2, 4, 6, 12]))
@settings(max_examples=300, deadline=None)
def test_runs_of_several_texts(texts, least):
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    h = B.mix(np.array([x for t in texts for x in t], np.uint64) + np.uint64(9))
    start, size, period = P.find_runs(h, offs, least)
    want = [(offs[k] + i, l, q) for k, t in enumerate(texts) for i, l, q in plain_runs(t, least)]
    assert list(zip(start, size, period)) == want


def test_long_texts():
    rng = random.Random(5)
    root = [rng.randrange(50) for _ in range(700)]
    s = root * 40 + [1] * 3000 + [0, 1] * 500
    words = B.mix(np.array(s, np.uint64))
    start, size, period = P.find_runs(words, np.array([0, len(s)]))
    got = set(zip(start.tolist(), size.tolist(), period.tolist()))
    assert any(q == 700 and l >= 28000 for _, l, q in got) and any(q == 1 and l >= 3000 for _, l, q in got) and any(q == 2 and l >= 1000 for _, l, q in got)
    for i, l, q in got:
        assert s[i:i + l - q] == s[i + q:i + l] and (i == 0 or s[i - 1] != s[i + q - 1]) and (i + l == len(s) or s[i + l] != s[i + l - q])


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words, 12)
    gone = {k for i, l, q in runs for k in range(i + q, i + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{i},{l},{q}\n" for i, l, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def test_query_against_brute_force(spark, tmp_dir):
    rng = random.Random(3)
    texts = [*EDGES, "a b " * 30 + "c " * 40, " ".join(rng.choice("xyz") for _ in range(300)), "p q\tr\ns " * 7 + "end"]
    texts += [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = documents(spark, texts)
    odd = spark.createDataFrame([(None, "u v " * 9, "en", "s", 1), (3, "twice " * 20, "en", "s", 1), (3, "twice " * 20, "en", "s", 1)], DOCS)
    docs = docs.unionByName(odd)
    saved(spark, tmp_dir, documents=docs.withColumnRenamed("source", "runs"))
    got = sorted((tuple(r) for r in P.query(spark, tmp_dir).collect()), key=repr)
    assert got == sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    short = {r.doc_id: r.text for r in docs.collect() if len((r.text or "").split()) < 400}
    rows = P.query(spark, SF).collect()
    assert len(rows) == docs.count() and sum(r.n_runs > 0 for r in rows) > 10
    for r in rows:
        if r.doc_id in short:
            assert tuple(r) == expected(r.doc_id, short[r.doc_id])

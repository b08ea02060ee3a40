"""Count automata against dictionaries; phrases against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import DOCS, EDGES, as_rows, documents, oracle, saved
from hypothesis import given, settings
from hypothesis import strategies as st

from busframes.llm import collocations as C
from busframes.llm.count_automata import CountAutomaton

U = np.uint64
SEQUENCES = st.dictionaries(st.lists(st.integers(1, 4), min_size=1, max_size=4).map(tuple), st.integers(1, 2**40), max_size=30)


def automaton(counts):
    rows = sorted(counts)
    wide = max(map(len, rows), default=1)
    columns = [np.array([r[j] if j < len(r) else 0 for r in rows], U) for j in range(wide)]
    return CountAutomaton.build(columns, np.array([len(r) for r in rows], np.int64), np.array([counts[r] for r in rows], np.int64))


def contents(a):
    out = {}
    for depth in range(1, 6):
        columns, count = a.sequences(depth, 1)
        out |= dict(zip(zip(*(c.tolist() for c in columns)), count.tolist()))
    return out


@given(st.lists(SEQUENCES, min_size=1, max_size=4))
@settings(max_examples=200, deadline=None)
def test_build_store_unite_and_compose(tables):
    parts = [CountAutomaton.from_bytes(automaton(t).to_bytes()) for t in tables]
    for part, t in zip(parts, tables):
        assert contents(part) == t
    total = Counter()
    for t in tables:
        total.update(t)
    whole = CountAutomaton.union(parts)
    assert contents(whole) == dict(total)
    asked = [*total, (9,), (1, 9), (1, 1, 1, 1), (4, 4)]
    wide = max(map(len, asked))
    columns = [np.array([q[j] if j < len(q) else 0 for q in asked], U) for j in range(wide)]
    got = whole.compose(columns, np.array([len(q) for q in asked]))
    assert got.tolist() == [total.get(q, 0) for q in asked]


def test_equal_futures_are_stored_once():
    same = {(a, b): 1 for a in range(1, 300) for b in (7, 8, 9)}
    other = {(a, b): a for a in range(1, 300) for b in (7, 8, 9)}
    assert len(automaton(same).to_bytes()) < len(automaton(other).to_bytes()) / 2


def brute(rows, least=100, top=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for c in ".,;:!?\n\x0b\x0c\r":
            text = (text or "").replace(c, "\n")
        for piece in text.translate(lower).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        kept = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        inside = Counter()
        for p, a in kept.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside[p[i:j]], a)
        rank = []
        for p, a in kept.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            rank.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i % 50, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)], DOCS)


def made(seed=1, n=900):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ärger", "漢字", "x-y"]
    rows = []
    for i in range(n):
        words = rng.choices(vocabulary, weights=[60 / (k + 1) for k in range(len(vocabulary))], k=rng.randrange(120))
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "  "]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None]), text + rng.choice(["", "New York City today", "a b; a b! A B"]) + " big red dog runs far" * 2))
    return rows + [("fr", "one two three four five six " * 120), ("en", ""), ("en", None), ("es", " ... !? \n")]


def test_against_brute_force(spark, tmp_dir):
    rows = made()
    docs = table(spark, rows)
    want = brute(rows)
    assert {r[0] for r in want} >= {"en", "fr", "und"} and len(want) > 30
    got = sorted(tuple(r) for r in C.collocations(docs.repartition(7).withColumnRenamed("source", "f")).collect())
    assert got == want
    saved(spark, tmp_dir, documents=docs)
    df = C.query(spark, tmp_dir)
    assert as_rows(df.columns, df.collect()) == oracle(C.ORACLE_SQL, documents=docs.toArrow())


@pytest.mark.parametrize("top", [1, 5])
def test_top_and_ties(spark, top):
    rows = [("en", "a b. c d. e f. b a! " * 120)]
    got = sorted(tuple(r) for r in C.collocations(table(spark, rows), top=top).collect())
    assert got == brute(rows, top=top)


def test_hot_prefixes_small_shards_and_bits(spark, monkeypatch):
    rows = made(4, 60)
    docs = table(spark, rows)
    want = brute(rows, least=20)
    with monkeypatch.context() as m:
        m.setattr(C, "HOT", 200)      # most words and many pairs count as hot
        m.setattr(C, "MAX_BITS", 15)
        counts, words, known = C.phrase_counts(docs.repartition(5), least=20)
        assert all(len(h) for h in known.hot[:3])
        got = sorted(tuple(r) for r in C.collocations(docs.repartition(5), least=20).collect())
    assert got == want


def test_awkward_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert C.collocations(empty).count() == 0
    assert C.collocations(documents(spark, [None, "", " . "])).count() == 0
    long = documents(spark, [*EDGES, ("deep sea " * 300_000)])
    rows = [(r.lang, r.text) for r in long.collect()]
    assert sorted(tuple(r) for r in C.collocations(long).collect()) == brute(rows)

import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import EDGES, documents, plain

from busframes.llm import ngram_join as J
from busframes.llm.graph import connected_components


def sets_of(text, k):
    w = plain(text)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute(docs, k, percent):
    sets = {i: sets_of(t, k) for i, t in docs}
    up = {i: i for i in sets}
    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=150):
    r = random.Random(seed)
    out = list(EDGES)
    for _ in range(n):
        if out and r.random() < 0.6:
            w = (r.choice(out[len(EDGES):] or ["seed text"]) or "").split()
            for _ in range(r.choice([0, 1, 1, 2, 5])):
                at = r.randrange(len(w) + 1)
                w[at:at + r.randrange(2)] = [f"v{r.randrange(50)}"] * r.randrange(2)
        else:
            w = [f"v{r.randrange(50)}" for _ in range(int(2 ** r.uniform(1, 8)))]
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 60), (3, 100)])
def test_keys_never_miss_a_similar_pair(k, percent):
    texts = [t or "" for t in corpus(k * 7 + percent, 160)]
    sets = J.shingle_sets(pa.array(texts), k)
    bounds = J._bounds(percent)
    keys = [set(J.set_keys(s, percent, bounds).tolist()) for s in sets]
    met = 0
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                met += 1
                assert keys[a] & keys[b], (a, b)
    assert met > 20


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (1, 60), (3, 100)])
def test_similar_pairs_share_as_many_keys_as_they_need(k, percent):
    """Whatever is held to be frequent, and also where half of a text is."""
    texts = [t or "" for t in corpus(k * 5 + percent, 160)]
    sets = J.shingle_sets(pa.array(texts), k)
    bounds = J._bounds(percent)
    frequent = J.Frequent(np.concatenate(sets)[::2])
    keys = []
    for s in sets:
        x, need = J.keys_and_needs(s, percent, bounds, frequent)
        keys.append({n: set(x[need == n].tolist()) for n in set(need.tolist())})
    met = 0
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                met += 1
                assert any(len(keys[a][n] & keys[b].get(n, set())) >= n for n in keys[a]), (a, b)
    assert met > 20


def test_rows_of_shared_keys_from_batches_cut_anywhere():
    r = random.Random(4)
    rows = sorted((r.randrange(12), r.randrange(9)) for _ in range(60))
    docs = {}
    for key, doc in rows:
        docs.setdefault(key, set()).add(doc)
    for _ in range(60):
        cuts = sorted([0, 60, *(r.randrange(61) for _ in range(r.randrange(40)))])
        batches = [pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows[a:b]], pa.int64()), pa.array([x[1] for x in rows[a:b]], pa.int64()), pa.array([2] * (b - a), pa.int32())],
                                              ["key", "doc", "need"]) for a, b in zip(cuts[:-1], cuts[1:])]
        got = {}
        for b in J._run_rows(iter(batches)):
            for run, doc in zip(b.column("run").to_pylist(), b.column("doc").to_pylist()):
                assert doc not in got.setdefault(run, set())
                got[run].add(doc)
        assert sorted(map(sorted, got.values())) == sorted(sorted(d) for d in docs.values() if len(d) > 1)


def test_passages_of_unlike_documents_make_no_cluster(spark):
    """A chain of documents, each with a passage of the one before it and one
    of the next, a sixth of its words each."""
    r = random.Random(2)
    def fresh(n):
        return [f"v{r.randrange(10 ** 9)}" for _ in range(n)]
    passages = [fresh(100) for _ in range(41)]
    texts = [" ".join(fresh(150) + passages[i] + fresh(100) + passages[i + 1] + fresh(150)) for i in range(40)]
    texts += [texts[7] + " end", texts[30].replace(" ", " mid ", 1)]
    docs = documents(spark, texts)
    clusters = {}
    for x in connected_components(J.key_edges(docs, 5, 80)).collect():
        clusters.setdefault(x.component, set()).add(x.id)
    assert sorted(map(sorted, clusters.values())) == [[7, 40], [30, 41]]
    got = {x.doc_id: x.component_id for x in J.jaccard_classes(docs, 5, 80).collect()}
    assert got == {i: {40: 7, 41: 30}.get(i, i) for i in range(42)}


@pytest.mark.parametrize("limit", [2_000_000, 60])
def test_classes_against_brute_force(spark, limit):
    """Small limits force clusters through the split path."""
    texts = corpus(5)
    docs = documents(spark, texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs, 3, 90, limit).collect()}
    assert got == brute(list(enumerate(texts)), 3, 90)


def test_split_cluster_with_stragglers(spark):
    """A chain of drifting copies: the cluster's ends aren't similar."""
    texts = [" ".join(f"c{j}" for j in range(i, i + 60)) for i in range(0, 90)] + [" ".join(f"c{j}" for j in range(3, 63)) + " x y"] * 3
    docs = documents(spark, texts)
    for limit in (2_000_000, 200):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_classes(docs, 3, 90, limit).collect()}
        assert got == brute(list(enumerate(texts)), 3, 90)


def test_matrix_opens_every_group_with_a_similar_set():
    sets = [s for s in J.shingle_sets(pa.array([t or "" for t in corpus(3, 200)]), 3) if len(s)]
    m = J.TokenGroups(sets, 90)
    opened = 0
    for i, s in enumerate(sets):
        groups = set(m.opened(s).tolist())
        opened += len(groups)
        for g, members in enumerate(m.groups):
            if any(m.similar(s, j) for j in members):
                assert g in groups
    assert opened < 0.7 * len(sets) * len(m.groups)


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (7, 5), (5, 9), (4, 4), (None, 1), (30, 20), (20, 10), (10, 40), (40, 50)], "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 9: 5, 10: 10, 20: 10, 30: 10, 40: 10, 50: 10}
    assert connected_components(edges.limit(0)).count() == 0


def test_stage_keeps_one_of_each_class(spark):
    base = " ".join(f"k{i}" for i in range(80))
    docs = documents(spark, [base, base + " end", base, "alone among the documents here", None, None, ""])
    assert sorted(r.doc_id for r in J.keep_one(spark, docs, "").collect()) == [0, 3, 4, 5, 6]


def test_each_text_of_a_doc_id_is_searched(spark):
    """A doc_id with a copy of a lower document and a near copy of another
    joins both classes."""
    r = random.Random(8)
    x, y, z = (" ".join(f"v{r.randrange(10 ** 6)}" for _ in range(80)) for _ in range(3))
    docs = spark.createDataFrame([(1, x), (5, x), (5, y), (9, y + " end"), (7, z), (4, z), (4, ""), (8, y.split()[0])], "doc_id long, text string")
    rows = J.jaccard_classes(docs, 5, 80).collect()
    assert len(rows) == 8
    assert {w.doc_id: w.component_id for w in rows} == {1: 1, 5: 1, 9: 1, 7: 4, 4: 4, 8: 8}


def test_components_of_many_edges_are_told_apart_without_overflow(spark):
    """Hashes below 2 ** 40 of 20 million edges add up to more than a long."""
    from pyspark.sql import functions as F

    from busframes.llm.graph import _fingerprint

    edges = spark.range(20_000_000).select(F.col("id").alias("a"), F.lit(-1).cast("long").alias("b"))
    n, total = _fingerprint(edges)
    assert n == 20_000_000 and total > 1 << 63

import random

import numpy as np
import pyarrow as pa
from helpers import EDGES, documents

from busframes.llm import bytesops as B
from busframes.llm import string_tiling as G


def brute_tiles(a, b, least):
    """Greedy string tiling by exhaustive search; total tile length."""
    ua, ub, total = [False] * len(a), [False] * len(b), []
    while True:
        best = 0, 0, 0
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ua[i + n] and not ub[j + n]:
                    n += 1
                if n > best[0]:
                    best = n, i, j
        n, i, j = best
        if n < least:
            return sorted(total)
        ua[i:i + n], ub[j:j + n] = [True] * n, [True] * n
        total.append(n)


def test_tiles_against_exhaustive_search():
    r = random.Random(2)
    same = 0
    for _ in range(60):
        a = [r.randrange(40) for _ in range(r.randrange(5, 60))]
        parts = [a[x:x + r.randrange(3, 30)] for x in (r.randrange(len(a)) for _ in range(4))]
        b = [w for p in parts for w in [*p, *(r.randrange(40) for _ in range(r.randrange(4)))]]
        tiles = G.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), 5)
        for n, i, j in tiles:
            assert a[i:i + n] == b[j:j + n]
        assert len({x for n, i, _ in tiles for x in range(i, i + n)}) == sum(t[0] for t in tiles)
        assert len({x for n, _, j in tiles for x in range(j, j + n)}) == sum(t[0] for t in tiles)
        want = brute_tiles(a, b, 5)
        assert max((t[0] for t in tiles), default=0) == max(want, default=0)
        same += sorted(t[0] for t in tiles) == want
    assert same >= 55  # equal lengths may be taken in another order


def test_reordered_and_scattered_passages(spark):
    item = [f"q{i}" for i in range(40)]
    filler = " ".join(f"f{i}" for i in range(30))
    texts = [*EDGES, " ".join(item), " ".join(item[20:] + ["mid"] + item[:20]), filler + " " + " ".join(item).upper() + ". " + filler,
             " ".join(item[:20]), " ".join(item[:33]), " ".join(w for p in range(0, 40, 4) for w in [*item[p:p + 4], "x"]), filler]
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(3, " ".join(item)), (8, None), (9, "a b"), (2, " ".join(item)), (5, "t1 t2 t3 t4 t5 t6")], "item_id long, text string")
    got = [r for r in sorted(G.contamination(docs, bench).collect(), key=lambda r: r.doc_id)][len(EDGES):]
    assert [r.contaminated for r in got] == [True, True, True, False, True, False, False]
    assert [r.item_id for r in got[:3]] == [2, 2, 2] and got[1].n_tiles == 2 and got[0].n_items == 2
    assert got[3].coverage == 0.5 and got[6].item_id is None
    kept = {r.doc_id for r in docs.join(G.contamination(docs, bench).filter("not contaminated"), "doc_id").collect()}
    assert kept == set(range(len(texts))) - {len(EDGES) + i for i in (0, 1, 2, 4)}


def test_slabs_give_the_same_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    rows = [sorted(map(str, (r.asDict() for r in G.tiled_pairs(docs.select("doc_id", "text"), bench, slab_words=s).selectExpr("doc_id", "sort_array(tiled) t").collect()))) for s in (4_000_000, 150)]
    assert rows[0] == rows[1]


def test_leaks_of_the_fixture_are_found(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    items = [f" {' '.join(r.text.lower().split())} " for r in bench.collect()]
    want = {r.doc_id for r in docs.collect() if any(i in f" {' '.join(r.text.lower().split())} " for i in items)}
    got = {r.doc_id for r in G.contamination(docs, bench).filter("contaminated").collect()}
    assert want and got == want


def test_repetitive_texts_in_bounded_memory():
    """A long text of one word against an item of the same word; and of a
    short cycle, against the exhaustive search of a part."""
    import tracemalloc

    items = G.Items([1, 2], ["same " * 200, " ".join(f"w{i % 3}" for i in range(90))], 5)
    one = B.hashed_words(pa.array(["same " * 200_000]))[0]
    tracemalloc.start()
    got = items.tiled(one)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(g[0], g[1]) for g in got] == [(1, 1.0)] and peak < 400 << 20
    a, b = [0, 1, 2] * 8 + [7, 8], [0, 1, 2] * 5 + [9] + [1, 2, 0] * 4
    tiles = G.greedy_tiles(np.array(a, np.uint64), np.array(b, np.uint64), 5)
    assert sorted(t[0] for t in tiles)[-1] == brute_tiles(a, b, 5)[-1]
    for n, i, j in tiles:
        assert a[i:i + n] == b[j:j + n]


def test_hits_in_small_portions(monkeypatch):
    r = random.Random(5)
    for _ in range(40):
        a, b = (np.array([r.randrange(3) for _ in range(r.randrange(5, 80))], np.uint64) for _ in range(2))
        used_a, used_b = (np.array([r.random() < 0.1 for _ in x]) for x in (a, b))
        whole = G._matches(a, b, used_a, used_b, 4)
        monkeypatch.setattr(G, "HITS", 3)
        assert sorted(G._matches(a, b, used_a, used_b, 4)) == sorted(whole)
        monkeypatch.undo()
        want = []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not used_a[i + n] and not used_b[j + n]:
                    n += 1
                if n >= 4 and (not i or not j or used_a[i - 1] or used_b[j - 1] or a[i - 1] != b[j - 1]):
                    want.append((n, i, j))
        assert sorted(whole) == sorted(want)


def test_other_columns_stay(spark):
    docs = documents(spark, ["a b c d e f g", None]).withColumnRenamed("source", "coverage").withColumnRenamed("lang", "item_id")
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert G.tiled_pairs(docs, bench).columns == [*docs.columns, "tiled"]
    assert [r.contaminated for r in sorted(G.contamination(docs, bench).collect(), key=lambda r: r.doc_id)] == [True, False]

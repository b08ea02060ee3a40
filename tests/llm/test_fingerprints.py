"""Bottom-k sketches against plain sets, the query against brute force."""

import hashlib
import random
import struct

import pytest
import xxhash
from helpers import DOCS, EDGES, SF, documents, saved
from pyspark.sql import functions as F

from busframes.llm import fingerprints as P


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def shingles(text):
    words = [signed(xxhash.xxh64_intdigest(w, 42)) for w in (text or "").encode().split()]
    parts = [words[i:i + 5] for i in range(len(words) - 4)] if len(words) >= 5 else [words] if words else []
    out = set()
    for p in parts:
        h = 42
        for w in p:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), h)
        out.add(signed(h))
    return out


def near(a, b, k=128):
    a, b = sorted(shingles(a))[:k], sorted(shingles(b))[:k]
    u = sorted({*a, *b})
    if len(a) == k or len(b) == k:
        u = u[:k]
    return sum(x in a and x in b for x in u) / len(u) if u else 1.0


def expected(rows):
    """Rows (doc_id, text) by descending doc_id, text hash."""
    low = -2**63
    order = sorted(rows, key=lambda r: (low if r[0] is None else r[0], signed(xxhash.xxh64_intdigest((r[1] or "").encode(), 42))), reverse=True)
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(text, edited), 12), round(near(text, other), 12),
                    "".join(f"{x & (2**64 - 1):016X}" for x in sorted(shingles(text))[:128]), "".join(f"{x & (2**64 - 1):016X}" for x in sorted(shingles(edited))[:128])))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12), r.fingerprint, r.edited_fingerprint)
                   for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert result(P.query(spark, SF)) == expected(rows)


@pytest.mark.parametrize("block_rows", [1, 3, 256])
def test_awkward_rows_in_small_blocks(spark, block_rows):
    rng = random.Random(block_rows)
    docs = documents(spark, [*EDGES, *(" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(900))) for _ in range(40))])
    hot = spark.createDataFrame([(7, f"row {i} of one id", "en", "s", 1) for i in range(60)] + [(None, f"no id {i % 3}", None, None, None) for i in range(9)]
                                + [(11, "same row again and again", "en", "s", 1)] * 5, DOCS)
    docs = docs.unionByName(hot)
    clash = docs.withColumnRenamed("source", "sketch").withColumnRenamed("lang", "next")
    assert result(P.compared(clash.repartition(4), block_rows)) == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_one_row_and_none(spark, tmp_dir):
    saved(spark, tmp_dir, documents=documents(spark, ["alone here"]))
    row = P.query(spark, tmp_dir).first()
    assert (row.near_next, row.near_edited) == (1.0, 1.0 if row.edited_sha256 == hashlib.sha256(b"alone here").hexdigest() else 0.0)
    assert P.with_next(spark.createDataFrame([], DOCS)).count() == 0


def test_estimates(spark):
    """Resemblance, containment and distinct counts of long texts."""
    rng = random.Random(8)
    base = [f"t{rng.randrange(10**6)}" for _ in range(20_000)]
    texts = [" ".join(base), " ".join(base[:14_000]), " ".join(base[10_000:] + [f"u{i}" for i in range(10_000)])]
    df = documents(spark, texts).select("doc_id", P.text_sketch(F.col("text"), 256).alias("s"))
    a, b = df.select(F.col("doc_id").alias("x"), F.col("s").alias("a")), df.select(F.col("doc_id").alias("y"), F.col("s").alias("b"))
    rows = a.crossJoin(b).select("x", "y", P.resemblance(F.col("a"), F.col("b"), 256).alias("r"), P.containment(F.col("a"), F.col("b"), 256).alias("c"),
                                 P.distinct_shingles(F.col("a"), 256).alias("n")).collect()
    sets = [shingles(t) for t in texts]
    for r in rows:
        s, t = sets[r.x], sets[r.y]
        assert abs(r.r - len(s & t) / len(s | t)) < 0.12 and abs(r.c - len(s & t) / len(s)) < 0.25 and abs(r.n / len(s) - 1) < 0.2


def test_merged_parts_are_the_sketch_of_all(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    parts = docs.select("lang", P.text_sketch(F.col("text")).alias("sketch"))
    got = {r.lang: r.sketch for r in P.merged(parts, ["lang"]).collect()}
    want = {}
    for r in docs.collect():
        want.setdefault(r.lang, set()).update(shingles(r.text))
    assert got == {k: sorted(v)[:128] for k, v in want.items() if v}

import math
from collections import Counter

import base64
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import zlib
from helpers import DOCS, EDGES, SF, documents, plain, saved

from busframes.llm import byte_cnn, suffix_tree_lm as L, toxic_fm, trie_counts
from busframes.llm import bytesops as B


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


# ------------------------------------------------------------- language

def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = byte_cnn.query(spark, sf).collect()
    assert len(rows) == len(lang) and all(r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_rows_without_doc_id_are_not_held_out(spark, tmp_dir):
    rows = [(i if i else None, f"some plain words number {i}", "en", "s", 1) for i in range(40)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    saved(spark, tmp_dir, documents=spark.createDataFrame(rows, DOCS), labels=labels)
    for query in (byte_cnn.query, toxic_fm.query):
        got = query(spark, tmp_dir).collect()
        assert len(got) == 40 and all(r.held_out in (True, False) for r in got) and not next(r for r in got if r.doc_id is None).held_out


def test_language_tables_equal_the_filters():
    net = byte_cnn.ByteCNN(["a", "b"])
    x = np.random.default_rng(0).integers(0, 255, (3, byte_cnn.WINDOW + byte_cnn.REACH)).astype(np.uint8)
    pooled = [sum(w[j][x[:, j:j + byte_cnn.WINDOW]] for j in range(len(w))).max(1) for w in net.weights]
    want = np.maximum(np.concatenate(pooled, 1) + net.bias, 0) @ net.out + net.out_bias
    assert np.allclose(net.logits(x, net.tables()), want, atol=1e-4)


def test_language_windows_cover_every_byte():
    texts = ["", "a" * 256, "b" * 257, "c" * 700]
    x, text = byte_cnn.windows(*B.text_buffer(pa.array(texts), lower=True))
    assert Counter(text.tolist()) == {0: 1, 1: 1, 2: 2, 3: 3}
    for i, t in enumerate(texts):
        assert b"".join(r[:256].tobytes() for r in x[text == i]).rstrip(b"\0").decode() == t


def test_language_awkward_documents(spark):
    docs = documents(spark, [*EDGES, "the house of the king and the queen"] * 2).withColumnRenamed("source", "score")
    model = byte_cnn.learn(docs)
    got = {r.doc_id: r for r in byte_cnn.identify(docs.select("doc_id", "text"), model).collect()}
    assert [got[i].lang_pred for i in (0, 1, 2, 9)] == ["und"] * 4 and got[10].lang_pred == "en" and got[0].score == 0
    kept = byte_cnn.keep_identified(spark, docs, "")
    assert set(kept.columns) == set(docs.columns) and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].lang_pred != "und"}
    none = byte_cnn.learn(docs.withColumn("lang", docs["lang"].substr(99, 1)).filter("lang is null"))
    assert {r.lang_pred for r in byte_cnn.identify(docs.select("doc_id", "text"), none).collect()} == {"und"}


# ------------------------------------------------------------- toxicity

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = toxic_fm.query(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count() and all(r.predicted == (r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert all(fold(r.doc_id, 4) == 2 for r in held)
    hit = sum(r.predicted and label[r.doc_id] for r in held)
    assert hit >= 0.9 * sum(label[r.doc_id] for r in held) and hit >= 0.9 * sum(r.predicted for r in held)


def test_machine_learns_a_pair_that_no_weight_can():
    """Toxic only with both terms: exclusive-or of two terms."""
    r = np.random.default_rng(0)
    bits = r.integers(0, 2, (2000, 2))
    y = (bits[:, 0] == bits[:, 1]).astype(float)
    m = toxic_fm.FactorizationMachine(np.array([3, 9])).fit([np.flatnonzero(b) for b in bits], y, epochs=60)
    p = m.margin(np.array([[0, 0], [0, 1], [1, 0], [1, 1]], float)) > 0
    assert p.tolist() == [True, False, False, True]


def test_a_pair_of_neutral_terms_is_found_and_learnt(spark):
    """Toxic where just one or none of two words stands, each neutral alone,
    among 200 other words; through ``learn``."""
    import random

    rng = random.Random(3)
    rows, labels = [], []
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"other{rng.randrange(200)}" for _ in range(25)] + ["greeting"] * a + ["neighbour"] * b
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1, int(a == b)))
    docs = spark.createDataFrame(rows, DOCS)
    truth = {d: t for d, _, t in labels}
    machine = toxic_fm.learn(docs, spark.createDataFrame(labels[:2000], "doc_id long, quality int, toxic int"))
    got = toxic_fm.scored(docs.filter("doc_id >= 2000").withColumnRenamed("lang", "score"), machine).collect()
    assert sum((r.score >= 0.5) == truth[r.doc_id] for r in got) >= 0.95 * len(got)
    none = toxic_fm.learn(docs, spark.createDataFrame([(d, 1, rng.randrange(2)) for d in range(2000)], "doc_id long, quality int, toxic int"))
    assert len(none.terms) < 40  # labels at random: hardly a term is kept


def test_machine_score_equals_its_margin():
    m = toxic_fm.FactorizationMachine(np.unique(toxic_fm.terms(pa.array(["alpha beta gamma"]))[0]))
    m.weight[:] = np.arange(len(m.terms)) / 7
    texts = ["beta", "alpha, BETA beta! zeta", None, ""]
    x = np.zeros((4, len(m.terms)))
    at, text = m.present(pa.array(texts))
    x[text, at] = 1
    assert np.allclose(m.score(pa.array(texts)), 1 / (1 + np.exp(-m.margin(x)))) and x[0].sum() == 1 and x[2].sum() == 0


def test_toxicity_awkward_documents(spark):
    docs = documents(spark, EDGES)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 0, None), (None, 0, 1), (3, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxic_fm.scored(docs, toxic_fm.learn(docs, labels)).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    only = toxic_fm.learn(docs, labels.filter("toxic = 0"))
    assert {round(r.score, 3) for r in toxic_fm.scored(docs, only).collect()} == {0.0}


# ------------------------------------------------------- language model

def test_lm_columns_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    words = {d: [*plain(t), None] for d, t in texts.items()}
    count = Counter(w for d, ws in words.items() if fold(d, 5) != 1 for w in ws)
    total, distinct = sum(count.values()), len(count)
    rows = L.query(spark, sf).collect()
    assert len(rows) == len(texts)
    better = 0
    for r in rows:
        ws = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold(r.doc_id, 5) == 1, len(ws), sum(count[w] > 0 for w in ws), total)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + .5) / (total + .5 * (distinct + 1))) for w in ws), rel_tol=1e-9)
        better += r.score - r.base_score if r.held_out else 0
    assert better > 0


def test_lm_distributions_add_up(spark):
    docs = documents(spark, ["a b c a b d", "a b c a b c", "b a", None, ""] * 6)
    tree, table = L.learn(docs, depth=3, least_context=1e-3, least_symbol=1e-3, gain=0.5)
    assert tree.distinct == 5 and tree.total == 114 and any(k.any() for k in tree.kept.values())
    names = {r.h: r.c for r in table.collect()}
    all_words = np.sort(np.array(list(names), np.int64).view(np.uint64))
    for history in (["a"], ["b"], ["a", "b"], ["c", "a", "b"], ["zz"], []):
        mass = 0.0
        for w in all_words:
            h = np.concatenate([B.hashed_words(pa.array([" ".join(history)]))[0], [w]])
            mass += 10 ** tree.score(tree.number(h), np.array([0, len(h)]))[-1]
        h = np.concatenate([B.hashed_words(pa.array([" ".join(history)]))[0], [np.uint64(12345)]])
        unknown = 10 ** tree.score(tree.number(h), np.array([0, len(h)]))[-1] * 10 ** float(tree.base(0))
        assert math.isclose(mass + unknown, 1, rel_tol=1e-6)
    got = {r.doc_id: r for r in L.scores(docs, tree, table).collect()}
    assert got[3].n_tokens == got[4].n_tokens == 1 and got[0].score > got[0].base_score and got[0].score == got[5].score


def test_lm_awkward_documents(spark, tmp_dir):
    saved(spark, tmp_dir, documents=documents(spark, [*EDGES, *EDGES]))
    rows = L.query(spark, tmp_dir).collect()
    assert len(rows) == 2 * len(EDGES) and all(r.score <= 0 and r.n_tokens >= 1 for r in rows)
    one = spark.createDataFrame([(6, "held out alone", None, None, None)], DOCS)  # crc32 mod 5 decides
    tree, table = L.learn(one.limit(0))
    r = L.scores(one, tree, table).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (4, 0, 0) and math.isclose(r.base_score, 0, abs_tol=1e-9)


def tree_scores(texts, depth=2, context=8, symbol=2, gain=30.0):
    """log10 scores of the texts by a suffix tree of them all, in plain Python."""
    seqs = [[*plain(t), None] for t in texts]
    count = [Counter(tuple(w[i:i + n]) for w in seqs for i in range(len(w) - n + 1)) for n in range(1, depth + 2)]
    total, norm = sum(count[0].values()), sum(count[0].values()) + .5 * (len(count[0]) + 1)
    nexts, kept, back = {}, set(), {}
    for n in range(1, depth + 1):
        for g, c in count[n].items():
            if c >= symbol and count[n - 1][g[:-1]] >= context:
                nexts.setdefault(g[:-1], {})[g[-1]] = c
    for ctx in sorted(nexts, key=len, reverse=True):
        m = count[len(ctx) - 1][ctx]
        p = {x: c / m for x, c in nexts[ctx].items()}
        q = {x: nexts[ctx[1:]][x] / count[len(ctx) - 2][ctx[1:]] if len(ctx) > 1 else (count[0][(x,)] + .5) / norm for x in p}
        rp, rq = (min(max(1 - sum(v.values()), 1e-12), 1) for v in (p, q))
        if m * (sum(p[x] * math.log(p[x] / q[x]) for x in p) + rp * math.log(rp / rq)) >= gain:
            kept |= {ctx[i:] for i in range(len(ctx))}
        back[ctx] = min(max(1 - sum((c - .5) / m for c in nexts[ctx].values()), 1e-12), 1)

    def prob(ctx, x):
        if not ctx:
            return (count[0][(x,)] + .5) / norm
        if ctx not in kept:
            return prob(ctx[1:], x)
        own = (nexts[ctx][x] - .5) / count[len(ctx) - 1][ctx] if x in nexts[ctx] else 0
        return own + back[ctx] * prob(ctx[1:], x)

    memo = {}
    def log(ctx, x):
        if (ctx, x) not in memo:
            memo[ctx, x] = math.log10(prob(ctx, x))
        return memo[ctx, x]

    return [sum(log(tuple(w[max(0, i - depth):i]), x) for i, x in enumerate(w)) for w in seqs], kept


def test_lm_tree_grows_with_the_corpus(spark, monkeypatch):
    """A word seen 8 times is a state among 500,000 tokens too, whether its
    entries travel or are joined."""
    r = np.random.default_rng(3)
    texts = ["filler " * 20000] * 25 + ["rare pair here"] * 8 + ["x a p y a r"] * 60 + [" ".join(f"w{i}" for i in r.zipf(1.6, 40) % 60) for _ in range(150)] + [None, ""]
    want, kept = tree_scores(texts)
    assert (b"rare",) in kept and any(len(k) == 2 for k in kept)
    docs = documents(spark, texts)
    for share in (L.TRAVEL, 0.01, 1.0):
        monkeypatch.setattr(L, "TRAVEL", share)
        tree, table = L.learn(docs)
        assert {d: int(n) for d, n in tree.kept.items()} == Counter(map(len, kept))
        got = {x.doc_id: x for x in L.scores(docs, tree, table).collect()}
        assert all(math.isclose(got[i].score, v, rel_tol=1e-9) for i, v in enumerate(want)) and got[25].score > got[25].base_score + 3


def test_lm_rows_that_repeat_long_texts_and_other_columns(spark):
    texts = ["one two three"] * 12 + ["a long text of words " * 60_000, None, ""]
    docs = documents(spark, texts)
    other = docs.withColumns({c: docs["source"] for c in ("id", "rid", "n", "bucket", "kind", "block", "score", "h", "c")})
    tree, table = L.learn(docs)
    again, words = L.learn(other)
    assert (tree.total, tree.distinct, tree.kept) == (again.total, again.distinct, again.kept) and table.count() == words.count()
    want = {r.doc_id: r for r in L.scores(docs, tree, table).collect()}
    got = L.scores(other.unionByName(other), again, words).collect()
    assert sorted(r.doc_id for r in got) == sorted([*want] * 2)
    assert all(math.isclose(r.score, want[r.doc_id].score, rel_tol=1e-9) and r.n_known == want[r.doc_id].n_known for r in got)
    assert want[12].n_tokens == 300_001 and want[13].n_tokens == want[14].n_tokens == 1
    assert L.scores(docs.limit(0), tree, table).collect() == []


def test_lm_blocks_give_back_their_columns():
    r = np.random.default_rng(5)
    for n in (1, 2, 1000):
        ids = np.sort(r.integers(0, 2**64, n, dtype=np.uint64))
        ids[-1] = 2**64 - 1
        x, y = r.integers(0, 3, n).astype(np.uint64), r.normal(size=n)
        a, b, c = L._unblock(L._block(L._steps(ids), x, y.view(np.uint64)), n, 3)
        assert (np.cumsum(a, dtype=np.uint64) == ids).all() and (b == x).all() and (c.view(float) == y).all()
        for buckets in (1, 7, 100_000):
            at = L._bucket(ids, buckets)
            assert (np.diff(at) >= 0).all() and at.min() >= 0 and at.max() < buckets


# --------------------------------------------------------- token counts

PIECES = trie_counts.ranked_pieces(P.path("byte_bpe_50k.tiktoken"))
VOCABULARY = trie_counts.Vocabulary(PIECES)


def viterbi(word):
    norm = math.log(sum(1 / (i + 1) for i in range(len(PIECES))))
    score = {p: -math.log(i + 1) - norm for i, p in enumerate(PIECES)}
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for e in range(1, len(word) + 1):
        for b in range(e - 1, max(-1, e - VOCABULARY.longest - 1), -1):
            s = score.get(word[b:e], -math.inf) + best[b][0]
            if s > best[e][0]:
                best[e] = s, best[b][1] + 1
    return best[-1][1], best[-1][0]


def test_counts_against_plain_viterbi(spark):
    texts = [*EDGES[:6], *EDGES[7:], "Hello  wide\tworld\n\n of tokens, é漢 and unbelievableness", "x" * 300]
    cut = [t for t in texts]
    rows = sorted(trie_counts.token_counts(documents(spark, cut)).collect(), key=lambda r: r.doc_id)
    import re
    for r, t in zip(rows, cut):
        parts = re.findall(rb" ?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]", (t or "").encode())
        want = {p: viterbi(p) for p in set(parts)}
        assert r.n_pre_tokens == len(parts) and r.n_tokens == sum(want[p][0] for p in parts)
        assert math.isclose(r.log_prob, sum(want[p][1] for p in parts), rel_tol=1e-9, abs_tol=1e-9)


def test_counts_of_tasks_with_one_edge_text_each(spark):
    for text in (None, "", " \n", "one"):
        row = trie_counts.token_counts(documents(spark, [text]).coalesce(1)).first()
        assert (row.n_tokens > 0) == bool(text) and isinstance(row.log_prob, float)


def test_counts_of_repeated_rows_and_other_columns(spark):
    docs = documents(spark, ["some words here", ""]).withColumnRenamed("source", "n_tokens").withColumnRenamed("lang", "log_prob")
    rows = trie_counts.token_counts(docs.unionByName(docs)).collect()
    assert sorted((r.doc_id, r.n_pre_tokens) for r in rows) == [(0, 3), (0, 3), (1, 0), (1, 0)]


def test_trie_shares_prefixes_and_long_words():
    words = [b" " + w for w in (b"token", b"tokens", b"tokenizer", b"to", b"unrelated", b"q" * 500)]
    buf = np.frombuffer(b"".join(words) + bytes(16), np.uint8)
    size = np.array([len(w) for w in words])
    tokens, best = trie_counts.trie_counts(buf, np.cumsum(size) - size, size, VOCABULARY)
    for w, t, s in zip(words, tokens, best):
        n, v = viterbi(w)
        assert t == n and math.isclose(s, v, rel_tol=1e-9)
    assert base64.b64encode(PIECES[0])

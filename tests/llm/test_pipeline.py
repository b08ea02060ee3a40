"""The pipeline against a composition of brute-force stages."""

import corpus_pipeline
from helpers import DOCS, documents, saved
from test_ngram_join import brute as classes
from test_packing import check

from busframes.llm import byte_cnn, ngram_join, suffix_repeats
from busframes.llm.suffix_repeats import whole_chars

ITEM = "the secret question of the benchmark asks how many small green apples lie under the old oak tree today"


def words(seed, n):
    import random

    r = random.Random(seed)
    return " ".join("".join(r.choice("aeiou") + r.choice("bcdfghlmnprst") for _ in range(r.randrange(1, 5))) for _ in range(n))


def texts():
    passage = words(99, 60)
    base = [words(i, 120) for i in range(12)]
    return [*base, base[0], base[1] + " ending", passage + " " + words(50, 90), words(51, 90) + " " + passage + " " + words(52, 30),
            words(53, 50) + " " + ITEM + " " + words(54, 50), ITEM.upper(), words(55, 40) + " " + " ".join(ITEM.split()[9:] + ITEM.split()[:9]),
            "12345 67890 !!", "", None, "é" * 10 + " " + words(56, 30)]


def uncovered(kept, length=200):
    """Texts without what 200-byte strings that start twice cover."""
    count = {}
    for t in kept.values():
        d = (t or "").encode()
        for p in range(len(d) - length + 1):
            count[d[p:p + length]] = count.get(d[p:p + length], 0) + 1
    out = {}
    for k, t in kept.items():
        d, spans = (t or "").encode(), []
        for p in range(len(d) - length + 1):
            if count[d[p:p + length]] > 1:
                if spans and p <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], p + length)
                else:
                    spans.append((p, p + length))
        at, parts = 0, []
        for s, e in [*whole_chars(d, spans), (len(d), len(d))]:
            parts.append(d[at:s])
            at = e
        out[k] = t if t is None else b"".join(parts).decode()
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "decontamination", "packing"]


def test_run_equals_brute_force(spark, tmp_dir):
    docs = documents(spark, texts())
    bench = spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string")
    saved(spark, tmp_dir, documents=docs, benchmark=bench)
    model = byte_cnn.learn(docs.filter(byte_cnn.remainder("doc_id", 5) != 0))
    ok = {r.doc_id: r.text for r in byte_cnn.identify(docs, model).filter("lang_pred <> 'und' and score >= 0.4").collect()}
    assert not {19, 20, 21} & set(ok)
    comp = classes(sorted(ok.items()), 5, 80)
    kept = uncovered({i: t for i, t in ok.items() if comp[i][1] == i})
    item = ITEM.split()

    def covered(text):  # the item's 5-word runs that the text holds, as a share of its words
        w = text.lower().split()
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
        hit = {j for i in range(len(item) - 4) if tuple(item[i:i + 5]) in grams for j in range(i, i + 5)}
        return len(hit) / len(item)

    left = {i: t for i, t in kept.items() if covered(t) < 0.8}
    assert set(kept) - set(left) == {16, 17, 18}
    rows = corpus_pipeline.run(spark, tmp_dir).collect()
    check(rows, left)
    assert {r.doc_id for r in rows} == set(left)


def test_repeated_rows_leave_one_document(spark, tmp_dir):
    """Rows repeated whole, rows without doc_id and a doc_id with two texts:
    one row of each group stays and its text reaches the packing."""
    a, b, c, d, e = (words(200 + i, 120) for i in range(5))
    rows = [(1, a), (1, a), (1, a), (None, b), (None, b), (None, b + " ending"), (2, c), (7, d), (7, e), (9, d), (None, d), (3, e), (None, c),
            (11, None), (11, None), (None, ""), (None, None), (12, a.upper()), (12, words(210, 50))]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], DOCS).repartition(3)
    saved(spark, tmp_dir, documents=docs)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(spark, docs, tmp_dir).collect()), key=repr)
    of_b = [x for x in kept if x[0] is None and x[1]]
    assert len(of_b) == 1 and of_b[0][1] in (b, b + " ending")
    assert [x for x in kept if x not in of_b] == sorted([(1, a), (2, c), (3, e), (7, d), (11, None), (None, ""), (None, None), (12, words(210, 50))], key=repr)
    left = suffix_repeats.drop_repeats(spark, ngram_join.keep_one(spark, docs, tmp_dir), tmp_dir)
    assert {r.text for r in left.collect()} >= {a, c, d, e, of_b[0][1]}


def test_stages_keep_the_columns(spark, tmp_dir):
    docs = documents(spark, texts()).withColumnRenamed("source", "rid")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    saved(spark, tmp_dir, benchmark=bench)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, tmp_dir).columns == docs.columns, name

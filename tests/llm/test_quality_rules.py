"""Fences that act on their own, against the fixed base rule."""

import random

from helpers import DOCS

from busframes.llm import quality_rules as Q


def _clean(rng, n):
    return " ".join(f"word{rng.randrange(10**6)}" for _ in range(n))


def _table(spark, texts, source="web"):
    return [(i, t, "en", source, len(t)) for i, t in enumerate(texts)]


def _kept(spark, rows):
    return {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(rows, DOCS)).collect()}


def test_repeats_in_a_clean_group_go_by_the_fence_alone(spark):
    rng = random.Random(1)
    texts = [_clean(rng, rng.randrange(80, 500)) for _ in range(200)]
    passage = _clean(rng, 50)
    texts.append(" ".join([_clean(rng, 150), passage, _clean(rng, 150), passage]))  # 25 % of 400 words
    boiler = _clean(rng, 12)
    texts.append(f"{boiler}\n{_clean(rng, 70)}\n{boiler}\n")  # 25 % of 94 words, one line
    lines = [_clean(rng, 7) for _ in range(20)]
    # a quarter of the lines stand there again, none long enough for a repeated window
    texts.append("\n".join(lines + [x for again in lines[:10] for x in (again, _clean(rng, 7))]))
    got = _kept(spark, _table(spark, texts))
    repeats, short, again = got[200], got[201], got[202]
    assert 4 * repeats.n_repeat_words == repeats.n_words and not repeats.base_failed and not repeats.kept
    assert 100 * short.n_repeat_words >= 25 * short.n_words and not short.base_failed and short.kept
    assert again.n_dup_lines == 10 and not again.base_failed and not again.kept
    assert sum(got[i].kept for i in range(200)) >= 198


def test_the_fence_follows_its_group(spark):
    """Where a source repeats itself as a rule, its documents stay."""
    rng = random.Random(2)
    clean = [_clean(rng, 300) for _ in range(100)]
    often = []
    for _ in range(100):
        passage = _clean(rng, rng.randrange(30, 42))
        often.append(" ".join([passage, _clean(rng, 200), passage]))  # about a quarter
    rows = _table(spark, clean, "clean") + [(1000 + i, t, "en", "often", 1) for i, t in enumerate(often)] + [(2000, often[0], "en", "clean", 1)]
    got = _kept(spark, rows)
    assert sum(got[1000 + i].kept for i in range(100)) >= 95
    big = " ".join([_clean(rng, 60)] * 2 + [_clean(rng, 300)])
    got = _kept(spark, rows + [(2001, big, "en", "clean", 1), (2002, big, "en", "often", 1)])
    assert not got[2001].kept and got[2002].kept and not got[2001].base_failed


def test_very_long_and_awkward_texts(spark):
    long = " ".join(f"w{i % 50_021}x{i % 7}" for i in range(400_000))
    rows = [(1, long, None, None, 1), (2, None, None, None, None), (3, "", "en", None, 0), (3, "", "en", None, 0)]
    got = _kept(spark, rows)
    assert got[1].n_words == 400_000 and got[2].base_failed and got[3].base_failed
    clash = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as n", "2 as signal", "3 as _lang", "4 as base_failed")
    assert Q.quality_rules(clash).count() == 4

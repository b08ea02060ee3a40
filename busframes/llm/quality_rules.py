"""Quality rules with adaptive thresholds (native: SQL functions only).

Signals of every text are computed in its own row (no shuffle). Per
(language, source) each signal feeds a mergeable quantile sketch: a histogram
with 64 to 127 buckets per power of two, so a bucket's lower bound is within
1/64 of every value in it. Sketches are plain (group, signal, bucket, count)
rows: partial aggregation builds them in the tasks and addition merges them
into the coarser levels (language, then everything). Fences of each group
come from its own sketch, or from the next coarser one when the group holds
fewer than ``min_group`` documents, and are joined back as the filter.

A fence lies ``reach`` spreads beyond a quartile, where the spread is the
group's own or a least one, small enough that in a clean group the fences for
repeated words and lines lie far below the fixed base rule.

Defined cases: null text counts as empty (no words, base rule fails); null
language or source is a group of its own; a document whose text repeats
another is judged alike; an empty table gives no rows; extra columns of the
input are ignored; a text's arrays of words and windows are held in one row,
whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframes.session import checkpoint_base

WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: (signal, least spread between the quartiles in thousandths, fenced below too, allowance)
#: The allowance, in lines or words of one document, doesn't count: a repeated
#: boilerplate line is a large share of a short clean text.
SIGNALS = (("word_len", 1000, True, 0), ("symbols", 50, False, 0), ("dup_lines", 60, False, 2), ("repeats", 40, False, 40))


def _let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once, even where body is a lambda."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(p: Column) -> Column:
        return F.filter(p, lambda s, j: ((j > 0) & (F.get(p, j - 1)["h"] == s["h"]))
                        | (F.coalesce(F.get(p, j + 1)["h"] == s["h"], F.lit(False))))

    starts = _let(pairs, lambda p: F.sort_array(F.transform(twice(p), lambda s: s["i"])))
    zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(
        starts, zero,
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")),
        lambda a: a["n"])


def _repeat_words(words: Column) -> Column:
    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _covered(windows)).otherwise(F.lit(0).cast("long"))

    def windows(h: Column) -> Column:
        return F.when(F.size(h) >= WINDOW,
                      F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.coalesce(_let(hashed, lambda h: _let(windows(h), count)), F.lit(0).cast("long"))


def text_signals(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """Counts of each whole text, in its own row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("_t"), F.array_remove(F.split(text, WHITE), "").alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return rows.select(
        *keep,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
                                       F.size(x).cast("long").alias("all"))).alias("_lines"),
        _repeat_words(F.col("_w")).alias("n_repeat_words"),
    ).select(*keep, "n_words", "word_chars", "n_symbols", F.col("_lines.dup").alias("n_dup_lines"),
             F.col("_lines.all").alias("n_lines"), "n_repeat_words")


def base_failed(min_words: int = 20, max_repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def _scaled() -> dict[str, Column]:
    """Signals in thousandths, whole numbers, beyond their allowance."""
    free = {k: n for k, _, _, n in SIGNALS}
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    per = {"word_len": (F.col("word_chars"), words), "symbols": (F.col("n_symbols"), words),
           "dup_lines": (F.col("n_dup_lines"), lines), "repeats": (F.col("n_repeat_words"), words)}
    return {k: F.floor((1000 * F.greatest(a - free[k], F.lit(0))) / b).cast("long") for k, (a, b) in per.items()}


def bucket(value: Column) -> Column:
    """Lower bound of a value's bucket: its 7 leading bits."""
    bits = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, bits), bits)


def sketch(signals: DataFrame, keys: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(keys, signal, bucket, n): one row per filled bucket."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), bucket(v).alias("bucket")) for k, v in _scaled().items()]))
    return (signals.select(*keys, each.alias("s")).groupBy(*keys, "s.signal", "s.bucket")
            .agg(F.count("*").alias("n")))


def quartiles(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Merge sketches down to ``keys`` and read both quartiles of each signal.

    The windows run over the buckets of one group (some hundred at most)."""
    from pyspark.sql import Window

    merged = sketches.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
    own = Window.partitionBy(*keys, "signal")
    ranked = merged.select("*", F.sum("n").over(own).alias("total"),
                           F.sum("n").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    return ranked.groupBy(*keys, "signal").agg(
        F.max("total").alias("n"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"))


def fences(sketches: DataFrame, min_group: int = 50, reach: int = 3) -> DataFrame:
    """(lang, source, <signal>_lo, <signal>_hi) for every group of the input."""
    fine = quartiles(sketches, ("lang", "source"))
    mid = quartiles(sketches, ("lang",)).select(F.col("lang").alias("_l"), F.col("signal").alias("_s"), F.struct("n", "q1", "q3").alias("mid"))
    top = quartiles(sketches, ()).select(F.col("signal").alias("_t"), F.struct("n", "q1", "q3").alias("top"))
    both = (fine.withColumn("fine", F.struct("n", "q1", "q3"))
            .join(mid, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("signal") == F.col("_s")))
            .join(top, F.col("signal") == F.col("_t")))
    used = both.select("lang", "source", "signal", F.when(F.col("fine.n") >= min_group, F.col("fine"))
                       .when(F.col("mid.n") >= min_group, F.col("mid")).otherwise(F.col("top")).alias("q"))
    aggs = []
    for name, least, below, _ in SIGNALS:
        mine = F.max(F.when(F.col("signal") == name, F.col("q")))
        spread = F.greatest(mine["q3"] - mine["q1"], F.lit(least))
        aggs.append((mine["q3"] + reach * spread).alias(f"{name}_hi"))
        aggs.append(((mine["q1"] - reach * spread) if below else F.lit(-1).cast("long")).alias(f"{name}_lo"))
    return used.groupBy("lang", "source").agg(*aggs)


def quality_rules(docs: DataFrame, min_group: int = 50, reach: int = 3, min_words: int = 20,
                  max_repeat_percent: int = 30) -> DataFrame:
    """Signals, base rule and verdict of every document.

    The signals are written once to the shared checkpoint folder: the sketches
    and the joined filter both read them."""
    checkpoint_base(docs.sparkSession)
    signals = text_signals(docs).withColumn("base_failed", base_failed(min_words, max_repeat_percent)).checkpoint()
    limits = fences(sketch(signals.filter(~F.col("base_failed"))), min_group, reach)
    limits = limits.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    judged = signals.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    scaled, ok = _scaled(), F.lit(True)
    for name, *_ in SIGNALS:
        ok &= scaled[name].between(F.col(f"{name}_lo"), F.col(f"{name}_hi"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & F.coalesce(ok, F.lit(False))).alias("kept"))


def _oracle(min_group: int = 50, reach: int = 3) -> str:
    counts = {"word_len": ("word_chars", "n_words"), "symbols": ("n_symbols", "n_words"), "dup_lines": ("n_dup_lines", "n_lines"),
              "repeats": ("n_repeat_words", "n_words")}
    scaled = {k: f"greatest({counts[k][0]} - {free}, 0) * 1000 // greatest({counts[k][1]}, 1)" for k, _, _, free in SIGNALS}
    floor = {k: v for k, v, _, _ in SIGNALS}
    below = {k: v for k, _, v, _ in SIGNALS}
    union = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS signal, {v} AS v FROM judged WHERE NOT base_failed" for k, v in scaled.items())
    def quart(keys: str, name: str) -> str:
        by = ", ".join(x for x in (keys, "signal") if x)
        return f"""{name} AS (SELECT {by}, max(total) AS n, min(CASE WHEN 4 * upto >= total THEN bucket END) AS q1,
  min(CASE WHEN 4 * upto >= 3 * total THEN bucket END) AS q3
  FROM (SELECT {by}, bucket, sum(n) OVER (PARTITION BY {by}) AS total, sum(n) OVER (PARTITION BY {by} ORDER BY bucket) AS upto
        FROM (SELECT {by}, bucket, count(*) AS n FROM buckets GROUP BY ALL)) GROUP BY {by})"""
    tests = " AND ".join(
        f"({v}) <= (SELECT q3 + {reach} * greatest(q3 - q1, {floor[k]}) FROM used u WHERE u.signal = '{k}' AND u.lang IS NOT DISTINCT FROM j.lang AND u.source IS NOT DISTINCT FROM j.source)"
        + (f" AND ({v}) >= (SELECT q1 - {reach} * greatest(q3 - q1, {floor[k]}) FROM used u WHERE u.signal = '{k}' AND u.lang IS NOT DISTINCT FROM j.lang AND u.source IS NOT DISTINCT FROM j.source)" if below[k] else "")
        for k, v in scaled.items())
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
grams AS (SELECT doc_id, i, list_slice(words, i, i + 7) AS g
          FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id),
counts AS (SELECT w.doc_id, lang, source, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
  len(lines) AS n_lines, coalesce(covered.n, 0) AS n_repeat_words FROM w LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
buckets AS (SELECT lang, source, signal, (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket FROM ({union})),
{quart("lang, source", "fine")}, {quart("lang", "mid")}, {quart("", "top")},
used AS (SELECT f.lang, f.source, f.signal,
   CASE WHEN f.n >= {min_group} THEN f.q1 WHEN m.n >= {min_group} THEN m.q1 ELSE t.q1 END AS q1,
   CASE WHEN f.n >= {min_group} THEN f.q3 WHEN m.n >= {min_group} THEN m.q3 ELSE t.q3 END AS q3
   FROM fine f JOIN mid m ON f.signal = m.signal AND f.lang IS NOT DISTINCT FROM m.lang JOIN top t ON f.signal = t.signal)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce({tests}, false) AS kept FROM judged j"""


ORACLE_SQL = _oracle()


def query(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))

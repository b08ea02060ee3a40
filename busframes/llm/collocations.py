"""Phrase collocations from weighted acyclic automata of n-gram counts.

Each task sorts the n-grams of a shard of its texts (a bounded number of
different ones) and builds their count automaton incrementally
(``count_automata``). A shard's automaton leaves the task cut by prefix range;
the automata of a range are united, weights added, which gives the count of
every phrase. Lengths go one by one: an n-gram can only be frequent if both
(n-1)-grams in it are, so a bit field of the frequent ones (2**27 bits at most,
64 a phrase as long as they suffice) spares the others the shuffle. False hits
cost time, never rows: what is frequent is decided by the united counts.

A range is a stretch of hashes of a phrase's shortest prefix that isn't hot;
a prefix with more than 1 / HOT of all words (there are at most HOT of each
length) is divided by what follows it. So no task gets a word's or a pair's
phrases whole, however frequent it is.

Parts of candidates are looked up by composition: the frequent phrases of a
range form one automaton, and the requests that fall into the range (every
part of every candidate, streamed) are composed with it. Hot single words are
asked in SALTS copies of their range.

Words are 64-bit hashes on the way; their text comes back for the phrases at
the top alone. Counts are exact (64 bits), scores use 38-digit decimals.

Defined cases: null text is empty, null lang ``und``; repeated rows and copies
count each time; texts of any length are handled whole; ties in rank go by
count, then phrase in byte order; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.llm.count_automata import CountAutomaton
from busframes.session import checkpoint_base

U = np.uint64
HOT = 65536
SALTS = 16
MAX_BITS = 27
SHARD = 1_200_000       # different n-grams that a task holds
UNITE_BYTES = 24 << 20  # automata of a range that are united at once
RANGE_WORDS = 1 << 21   # words of the input for each prefix range
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
APART = BREAK.copy()
APART[[9, 32]] = True


def seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode(), 11)


def _text_words(column):
    """(bytes, word starts, sizes, text of each word, words left in its piece
    from each word on)."""
    buf, offs = B.text_buffer(column, lower=True)
    n = int(offs[-1])
    inside = ~APART[buf[:n]]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offs[:-1] < offs[1:]
    a, b = offs[:-1][filled], offs[1:][filled] - 1
    first[a], last[b] = inside[a], inside[b]
    start = np.flatnonzero(first)
    size = np.flatnonzero(last) + 1 - start
    text = np.searchsorted(offs, start, "right") - 1
    piece = np.cumsum(BREAK[buf[:n]])[start]
    ends = np.ones(len(start), bool)
    ends[:-1] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    end = np.flatnonzero(ends)
    return buf, start, size, text, (end[np.searchsorted(end, np.arange(len(start)))] - np.arange(len(start)) + 1) if len(start) else start


def _names(buf, start, size) -> pa.Array:
    data = buf[B.expand(start, size)]
    offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offs.tobytes()), pa.py_buffer(data.tobytes())])


class Known:
    """What tasks know of the shorter phrases: bits of frequent ones by hash,
    hashes of hot prefixes by length, number of ranges."""

    def __init__(self, ranges: int):
        self.ranges, self.bits, self.width, self.hot = ranges, None, 0, []

    def frequent(self, key: np.ndarray) -> np.ndarray:
        at = key >> U(64 - self.width)
        return (self.bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 > 0

    def range_of(self, keys: list[np.ndarray], length: np.ndarray | None = None) -> np.ndarray:
        """Prefix range of phrases; keys: hashes of their prefixes by length."""
        route = keys[0].copy()
        still = np.arange(len(route))
        for d, hot in enumerate(self.hot[:len(keys) - 1]):
            still = still[np.isin(keys[d][still], hot)]
            if length is not None:
                still = still[length[still] > d + 1]
            route[still] = keys[d + 1][still]
        return ((B.mix(route) >> U(32)) * U(self.ranges) >> U(32)).astype(np.int64)


def chain(key: np.ndarray | None, seeds: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Hash of a prefix with one more word."""
    return B.mix(label + seeds) if key is None else B.mix(B.mix(key) + label)


def _emit(held: list, langs: list[str], level: int, known: Known) -> Iterator[pa.RecordBatch]:
    """One row (lang, range, automaton) per language and prefix range."""
    key = np.concatenate([x[0] for x in held])
    count = np.concatenate([x[1] for x in held])
    order = np.argsort(key, kind="stable")
    cuts = B.runs(key[order])
    count = np.add.reduceat(count[order], cuts[:-1])
    order = order[cuts[:-1]]
    lang, rng = (np.concatenate([x[k] for x in held])[order] for k in (2, 3))
    columns = [np.concatenate([x[4][j] for x in held])[order] for j in range(level)]
    names = pa.concat_arrays([x[5] for x in held]).take(pa.array(order)) if level == 1 else None
    held.clear()
    order = np.lexsort((*columns[::-1], rng, lang))
    count, lang, rng = count[order], lang[order], rng[order]
    columns = [c[order] for c in columns]
    names = names.take(pa.array(order)) if names is not None else None
    cuts = B.runs(lang * known.ranges + rng)
    rows: list[list] = [[], [], [], []]
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = CountAutomaton.build([c[a:b] for c in columns], np.full(b - a, level), count[a:b])
        blob = part.to_bytes()
        text = b"\n".join(names[a:b].to_pylist()) if names is not None else None
        for to, v in zip(rows, (langs[lang[a]], int(rng[a]), blob, text)):
            to.append(v)
        if len(rows[0]) >= 64:
            yield _piece_rows(rows)
            rows = [[], [], [], []]
    if rows[0]:
        yield _piece_rows(rows)


def _piece_rows(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, (pa.string(), pa.int64(), pa.binary(), pa.binary()))],
                                      ["lang", "rng", "counts", "names"])


def shards(docs: DataFrame, level: int, known: Known) -> DataFrame:
    """(lang, rng, counts, names): the automata of each task's n-grams of
    ``level`` words, cut by prefix range."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, langs, held, rows = sent.value, [], [], 0
        for whole in batches:
            for b in B.slices(whole):
                buf, start, size, text, room = _text_words(b.column("text"))
                if not len(start):
                    continue
                coded = b.column("lang").dictionary_encode()
                here = coded.dictionary.to_pylist()
                for x in here:
                    if x not in langs:
                        langs.append(x)
                code = coded.indices.to_numpy(zero_copy_only=False)[text]
                seeds = np.array([seed(x) for x in here], U)[code]
                number = np.array([langs.index(x) for x in here])[code]
                h = B.hash_spans(buf, start, size)
                at = np.flatnonzero(room >= level)

                def prefixes(at, n):
                    keys = [chain(None, seeds[at], h[at])]
                    for j in range(1, n):
                        keys.append(chain(keys[-1], seeds[at], h[at + j]))
                    return keys

                if level > 1:
                    at = at[known.frequent(prefixes(at, level - 1)[-1])]
                    at = at[known.frequent(prefixes(at + 1, level - 1)[-1])]
                if not len(at):
                    continue
                keys = prefixes(at, level)
                key, first, count = np.unique(keys[-1], return_index=True, return_counts=True)
                at, keys = at[first], [k[first] for k in keys]
                held.append((key, count, number[at], known.range_of(keys), [h[at + j] for j in range(level)],
                             _names(buf, start[at], size[at]) if level == 1 else None))
                rows += len(at)
                if rows >= SHARD:
                    yield from _emit(held, langs, level, known)
                    rows = 0
        if held:
            yield from _emit(held, langs, level, known)
        B.release()

    text = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return text.mapInArrow(run, "lang string, rng long, counts binary, names binary")


FOUND = "lang string, words array<long>, key long, name string, f long"


def _found(lang: str, columns: list[np.ndarray], count: np.ndarray, names: list | None = None) -> pa.RecordBatch:
    n, level = len(count), len(columns)
    key = None
    for c in columns:
        key = chain(key, np.full(n, seed(lang), U), c)
    flat = np.column_stack(columns).ravel().view(np.int64)
    words = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * level), pa.array(flat))
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), words, pa.array(key.view(np.int64)), pa.array(names or [None] * n, pa.string()), pa.array(count, pa.int64())],
        ["lang", "words", "key", "name", "f"])


def united(pieces: DataFrame, level: int, least: int) -> DataFrame:
    """FOUND rows of the phrases that occur ``least`` times or more; of
    single words also one row per range without words, all their counts."""
    def close(lang, parts, names) -> Iterator[pa.RecordBatch]:
        whole = CountAutomaton.union(parts)
        columns, count = whole.sequences(level, least)
        if len(count):
            yield _found(lang, columns, count, [names[x] for x in columns[0].tolist()] if level == 1 else None)
        if level == 1:
            total = pa.array([int(whole.layers[0][3].sum())], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([[]], pa.list_(pa.int64())), pa.array([None], pa.int64()), pa.array([None], pa.string()), total],
                                             ["lang", "words", "key", "name", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, names, size = None, [], {}, 0
        for batch in batches:
            for lang, rng, blob, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "rng", "counts", "names"))):
                if (lang, rng) != now:
                    if now:
                        yield from close(now[0], parts, names)
                    now, parts, names, size = (lang, rng), [], {}, 0
                parts.append(CountAutomaton.from_bytes(blob))
                if level == 1:
                    names.update(zip(parts[-1].layers[0][2].tolist(), text.decode().split("\n")))
                size += len(blob)
                if size >= UNITE_BYTES:
                    parts = [CountAutomaton.union(parts)]
                    size = 0
        if now:
            yield from close(now[0], parts, names)
        B.release()

    parts = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(parts, "lang", "rng").sortWithinPartitions("lang", "rng").mapInArrow(run, FOUND)


def _learn(known: Known, found: DataFrame, n_words: int) -> int:
    """Take up a length's frequent phrases; returns how many there are."""
    some = found.filter(F.size("words") > 0)
    n = some.count()
    known.width = min(MAX_BITS, max(15, int(64 * max(n, 1) - 1).bit_length()))
    place = F.call_function("shiftrightunsigned", F.col("key"), F.lit(64 - known.width)) + 1
    chunks = some.groupBy(F.bitmap_bucket_number(place).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    known.bits = np.zeros(1 << known.width >> 3, np.uint8)
    for c in chunks:  # 4 KB each, 2**MAX_BITS bits together at most
        bits = np.frombuffer(c["bits"], np.uint8)
        at = (c["at"] - 1) * len(bits)
        known.bits[at:at + len(bits)] = bits[:len(known.bits) - at]
    hot = some.filter(F.col("f") * HOT > n_words).select("key").collect()  # fewer than HOT
    known.hot.append(np.sort(np.array([r[0] for r in hot], np.int64).view(U)))
    return n


def phrase_counts(docs: DataFrame, longest: int = 5, least: int = 100) -> tuple[DataFrame, DataFrame, Known]:
    """(FOUND rows of all phrases of 1 to ``longest`` words that occur
    ``least`` times or more in a language, (lang, n) of all its words, what
    lookups need to know)."""
    spark = docs.sparkSession
    checkpoint_base(spark)
    B.prepare(spark)
    known = Known(max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    out = words = None
    for level in range(1, longest + 1):
        found = united(shards(docs, level, known), level, least).checkpoint()
        if level == 1:
            words = found.filter(F.size("words") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
            n_words = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            found = found.filter(F.size("words") > 0)
        out = found if out is None else out.unionByName(found)
        if not _learn(known, found, n_words):
            break
        known.ranges = max(known.ranges, n_words // RANGE_WORDS)
    return out, words, known


def part_counts(counts: DataFrame, known: Known) -> DataFrame:
    """(lang, words, f, at, size, part, part_f): every proper part of every
    phrase of two words or more, with its count."""
    spark = counts.sparkSession
    sent = spark.sparkContext.broadcast(known)
    kind = "lang string, rng long, salt int, asks boolean, part array<long>, f long, words array<long>, at int"

    def columns_of(lists: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = lists.flatten().to_numpy().view(U)
        begin = np.cumsum(size) - size
        return [np.where(size > j, flat[np.minimum(begin + j, max(len(flat) - 1, 0))], U(0)) for j in range(size.max(initial=0))], size

    def lists(columns: list[np.ndarray], size: np.ndarray) -> pa.Array:
        flat = np.column_stack(columns)
        on = np.arange(flat.shape[1]) < size[:, None]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat[on].view(np.int64)))

    def routed(known, seeds, columns, size):
        """(range, whether it is a hot single word) of phrases."""
        keys = []
        for c in columns:
            keys.append(chain(keys[-1] if keys else None, seeds, c))
        return known.range_of(keys, size), (size == 1) & np.isin(keys[0], known.hot[0])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for b in batches:
            if not b.num_rows:
                continue
            lang, words, f = b.column("lang"), b.column("words"), b.column("f").to_numpy()
            columns, size = columns_of(words)
            seeds = np.array([seed(x) for x in lang.to_pylist()], U)

            def rows(pick, at, part_columns, part_size, asks, salt, rng):
                n = len(pick)
                took = pa.array(pick)
                yield pa.RecordBatch.from_arrays(
                    [lang.take(took), pa.array(rng), pa.array(salt.astype(np.int32)), pa.array(np.full(n, asks)), lists(part_columns, part_size),
                     pa.array(f[pick]), words.take(took) if asks else pa.nulls(n, pa.list_(pa.int64())), pa.array(np.full(n, at, np.int32))],
                    ["lang", "rng", "salt", "asks", "part", "f", "words", "at"])

            rng, hot = routed(known, seeds, columns, size)
            copies = np.where(hot, SALTS, 1)
            pick = np.repeat(np.arange(len(size)), copies)
            yield from rows(pick, 0, [c[pick] for c in columns], size[pick], False, B.expand(np.zeros(len(size), np.int64), copies), rng[pick])
            for at in range(len(columns)):
                for n in range(1, len(columns)):
                    pick = np.flatnonzero((at + n <= size) & (n < size))
                    if len(pick):
                        part = [c[pick] for c in columns[at:at + n]]
                        rng, hot = routed(known, seeds[pick], part, np.full(len(pick), n))
                        salt = np.where(hot, (B.mix(columns[0][pick] + columns[1][pick] + f[pick].astype(U)) % U(SALTS)).astype(np.int64), 0)
                        yield from rows(pick, at, part, np.full(len(pick), n), True, salt, rng)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by (lang, range, salt), counts first, sorted: the counts build
        the range's automaton, the requests after them are composed with it."""
        now, held, automaton = None, [], None

        def built():
            size = np.concatenate([x[1] for x in held])
            wide = max(len(x[0]) for x in held)
            columns = [np.concatenate([x[0][j] if j < len(x[0]) else np.zeros(len(x[1]), U) for x in held]) for j in range(wide)]
            count = np.concatenate([x[2] for x in held])
            order = np.lexsort(columns[::-1])  # as unsigned labels
            return CountAutomaton.build([c[order] for c in columns], size[order], count[order])

        for b in batches:
            key = list(zip(*(b.column(c).to_pylist() for c in ("lang", "rng", "salt"))))
            a = 0
            while a < len(key):
                z = a
                while z < len(key) and key[z] == key[a]:
                    z += 1
                if key[a] != now:
                    now, held, automaton = key[a], [], None
                part = b.slice(a, z - a)
                asks = part.column("asks").to_numpy(zero_copy_only=False)
                mine = part.filter(pa.array(~asks))
                if mine.num_rows:
                    held.append((*columns_of(mine.column("part")), mine.column("f").to_numpy()))
                asked = part.filter(pa.array(asks))
                if asked.num_rows:
                    automaton = automaton or built()
                    columns, size = columns_of(asked.column("part"))
                    got = automaton.compose(columns, size)
                    yield pa.RecordBatch.from_arrays(
                        [asked.column("lang"), asked.column("words"), asked.column("f"), asked.column("at"), pa.array(size.astype(np.int32)), asked.column("part"), pa.array(got)],
                        ["lang", "words", "f", "at", "size", "part", "part_f"])
                a = z

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = counts.select("lang", "words", "f").mapInArrow(deal, kind)
    return (dealt.repartition(parts, "lang", "rng", "salt").sortWithinPartitions("lang", "rng", "salt", "asks")
            .mapInArrow(answer, "lang string, words array<long>, f long, at int, size int, part array<long>, part_f long"))


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:
    wide = "decimal(19,0)"
    return F.call_function("div", (1000 * a).cast(wide) * n.cast(wide), l.cast(wide) * r.cast(wide))


def collocations(docs: DataFrame, longest: int = 5, least: int = 100, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top``
    phrases of 2 to ``longest`` words that occur ``least`` times or more."""
    counts, words, known = phrase_counts(docs, longest, least)
    parts = part_counts(counts, known).checkpoint()
    size = F.size("words")
    aggs = []
    for k in range(1, longest):
        aggs += [F.max(F.when((F.col("at") == 0) & (F.col("size") == k), F.col("part_f"))).alias(f"l{k}"),
                 F.max(F.when((F.col("at") == k) & (F.col("size") == size - k), F.col("part_f"))).alias(f"r{k}")]
    phrases = parts.groupBy("lang", "words").agg(F.max("f").alias("a"), *aggs)
    inside = parts.filter((F.col("size") > 1) & (F.col("f") >= F.col("part_f"))).select("lang", F.col("part").alias("words")).distinct()
    # counts never grow with a phrase, so a part as frequent as the whole goes
    rows = phrases.join(inside, ["lang", "words"], "left_anti").join(F.broadcast(words) if words.count() <= HOT else words, "lang")
    cuts = F.array(*[F.when(size > k, F.struct(_score(F.col("a"), F.col("n"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"),
                                               F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))) for k in range(1, longest)])
    cut = F.array_min(F.filter(cuts, lambda c: c.isNotNull()))
    rows = rows.select("lang", "words", "a", "n", cut.alias("cut")).select("lang", "words", "a", "cut.l", "cut.r", "n", "cut.score")
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = rows.withColumn("near", F.rank().over(by)).filter(F.col("near") <= top)  # with all that tie at the end
    names = counts.filter(F.size("words") == 1).select("lang", F.col("words")[0].alias("word"), "name")
    spelt = (best.select("*", F.posexplode("words").alias("pos", "word")).join(names, ["lang", "word"])
             .groupBy("lang", "words", "a", "l", "r", "n", "score")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"]), " ").alias("phrase")))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (spelt.withColumn("rank", F.row_number().over(last).cast("long")).filter(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE_SQL = r"""
WITH w AS (SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS words FROM (
    SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
n AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
    GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
inner_parts AS (SELECT DISTINCT c.lang, array_to_string(c.words[i:i + j - 1], ' ') AS phrase, c.f AS whole
    FROM c, (SELECT unnest([2, 3, 4]) AS j), (SELECT unnest([1, 2, 3, 4]) AS i) WHERE j < c.k AND i + j - 1 <= c.k),
gone AS (SELECT DISTINCT p.lang, p.phrase FROM inner_parts p JOIN f ON f.lang = p.lang AND f.phrase = p.phrase WHERE 100 * p.whole >= 100 * f.f),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, n.n,
      ((1000::HUGEINT * c.f * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM c CROSS JOIN (SELECT unnest([1, 2, 3, 4]) AS j) JOIN n ON n.lang = c.lang
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:j], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[j + 1:c.k], ' ')
    WHERE j < c.k AND NOT EXISTS (SELECT 1 FROM gone WHERE gone.lang = c.lang AND gone.phrase = c.phrase)),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest QUALIFY rank <= 2000"""


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))

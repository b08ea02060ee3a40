"""Language-model scoring with a probabilistic suffix tree over words.

States are contexts of 0 to ``depth`` words. A context is a candidate if it
occurs ``least_context`` times in the training texts, a next word counts if
its pair with the context occurs ``least_symbol`` times (below 1: shares of
all training tokens); so the tree grows with the corpus. A candidate stays if
its next words diverge from those of its suffix: count * KL >= ``gain`` nats,
what is not counted being one symbol; so do the suffixes of what stays.
Distributions are smoothed by absolute discounting, the discounted mass going
to the suffix state and in the end to the additive root. A word is scored by
the longest suffix of its history that is a state.

An n-gram's id is a 64-bit hash of the ids of its first and its last n - 1
words, a word's that of the word. N-grams are counted in tasks before the
shuffle and cross it in compressed blocks, one per bucket (a range of ids; as
many buckets as the corpus needs), added up bucket by bucket; states and
entries are Spark tables, joined level by level, hot keys salted, and deleted
once the model is written. A log probability is a sum over the n-grams that end at the word or
before it (``own`` of an entry: what it adds to its state's back-off and the
shorter contexts; ``back`` of a context), so the model is one table by id. Of
it only n-grams of at least TRAVEL of all tokens are broadcast, with at most
2 ** BITS bits that say which ids can be in the table (fuller bits let more
pass, results stay); a text's other n-grams that may be in
it meet the model's buckets as blocks too, and come back as sums per text.

Defined cases: null text is empty (its only token is the end); texts repeated
are scored alike, rows of one doc_id one by one; a very long text is held as a
whole by one task, a few words of 64 bits for each of its tokens; without training texts every count is 0; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.session import checkpoint_base, shared_dir

U = np.uint64
END = U(0xE0D0E0D0E0D0E0D1)
DISCOUNT = 0.5
BITS = 27
SALTS = 32
HOT = 1e-5  # share of all tokens from which a key of a join is salted
TRAVEL = 2e-6  # share from which an n-gram is broadcast: 1 / TRAVEL of each length at most
BUCKET = 2 << 20  # n-grams of a bucket that a task holds at a time, on average


def tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words and, last, the end of each text; offsets)."""
    h, offs = B.hashed_words(column)
    return np.insert(h, offs[1:], END), offs + np.arange(len(offs))


def _before(values: np.ndarray) -> np.ndarray:
    return np.concatenate([values[:1], values[:-1]])


def grams(h: np.ndarray, offs: np.ndarray, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``most`` words: ids of the n-grams that end at each token, and
    whether the text holds that many words up to there."""
    first = np.zeros(len(h) + 1, bool)
    first[offs] = True
    out = [(h, np.ones(len(h), bool))]
    for _ in range(1, most):
        ids, held = out[-1]
        out.append((B.mix(B.mix(_before(ids) ^ END) + ids), _before(held) & ~first[:-1]))
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions in sorted keys, -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _buckets(spark, rows: int, each: int = BUCKET) -> int:
    """Buckets for that many rows, and for every core of the cluster."""
    return max(2 * spark.sparkContext.defaultParallelism, -(-rows // each))


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each id: a range of ids, so sorted ids are sorted by it."""
    return (((ids >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)


def _block(*columns: np.ndarray) -> bytes:
    """Columns of 64 bits, compressed byte by byte of their numbers."""
    return pa.compress(np.concatenate([c.view(np.uint8).reshape(-1, 8).T for c in columns]).tobytes(), codec="zstd", asbytes=True)


def _unblock(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, 8 * columns * n, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(c.T).view(U).ravel() for c in raw]


def _steps(values: np.ndarray) -> np.ndarray:
    """Differences of neighbours; np.cumsum undoes it."""
    return np.diff(values, prepend=U(0))


def _delete(spark, path: str) -> None:
    from pyarrow import fs as pafs

    filesystem, root = pafs.FileSystem.from_uri(path)
    filesystem.delete_dir(root)


def _bits(ids: DataFrame, rows: int) -> np.ndarray:
    """What may be in the table: bits by the leading bits of the ids, 16 for
    each of its rows or 2 ** BITS in all, in words of 64."""
    width = min(BITS, max(12, (16 * rows).bit_length()))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned("id", 64 - width).bitwiseAND(F.lit(63)).cast("int"))
    got = ids.groupBy(F.shiftrightunsigned("id", 70 - width).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    out = np.zeros(1 << (width - 6), U)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy().view(U)
    return out


def _may(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    at = ids >> U(65 - len(bits).bit_length() - 6)
    return (bits[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1


class SuffixTree:
    """What travels of the model: sorted ids with base (log10 probability of a
    word at the root, else nan), own and back; bits of the whole model, which
    is the table ``model``. kept[d]: number of states of d words."""

    def __init__(self, model: DataFrame, total: int, distinct: int, depth: int, kept: dict):
        self.model, self.total, self.distinct, self.depth, self.kept = model, total, distinct, depth, kept
        self.often = max(1, int(np.ceil(TRAVEL * total)))
        got = model.filter(F.col("c") >= self.often).drop("c").toArrow()
        order = np.argsort(ids := got.column("id").to_numpy().view(U))
        self.ids = ids[order]
        self.values, self.own, self.back = (got.column(c).to_numpy()[order].astype(float) for c in ("base", "own", "back"))
        self.rows = model.count()
        self.bits = _bits(model.select("id"), self.rows)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "model"}

    def base(self, count):
        return np.log10((np.asarray(count, float) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))

    def number(self, h: np.ndarray) -> np.ndarray:
        return h

    def parts(self, h: np.ndarray, offs: np.ndarray):
        """(root, score) of each token as far as the n-grams travel, root nan
        for other words; (tokens, ids) of the n-grams to be looked up."""
        root, score, rest = np.full(len(h), np.nan), np.zeros(len(h)), []
        last = np.zeros(len(h) + 1, bool)
        last[offs[1:] - 1] = True
        for n, (ids, held) in enumerate(grams(h, offs, self.depth + 1)):
            on = np.flatnonzero(held & _may(self.bits, ids))
            at = _find(self.ids, ids[on])
            other = on[at < 0]
            rest.append((other, ids[other]))
            on, at = on[at >= 0], at[at >= 0]
            if n == 0:
                root[on] = self.values[at]
                score[on] += self.values[at]
            score[on] += self.own[at]
            go = ~last[on]
            score[on[go] + 1] += self.back[at[go]]
        return root, score, rest

    def score(self, h: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """log10 probability of each token, as far as its n-grams travel; for
        unknown words only what their states leave to the root."""
        return self.parts(h, offs)[1]


def _summed(batches, keys_of, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """(h, c): keys of the batches, added up in the task."""
    def flush(held):
        key, count = np.unique(np.concatenate(held), return_counts=True)
        for a in range(0, len(key), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[a:a + 200_000].astype(np.int64, copy=False)), pa.array(count[a:a + 200_000])], ["h", "c"])

    held, size = [], 0
    for whole in batches:
        for b in B.slices(whole, most=2 << 20):
            held.append(keys_of(*tokens(b.column("text"))))
            size += len(held[-1])
            if size >= most:
                yield from flush(held)
                held, size = [], 0
    if held:
        yield from flush(held)


def _counted(texts: DataFrame, n: int, sent, least: int, buckets: int) -> DataFrame:
    """(id, a, b, c): n-grams of at least ``least`` whose first n - 1 words (a)
    may be a context and whose last n - 1 words (b) may be counted, by the two
    bits that were sent."""

    def flush(held):
        ids, a, b = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(ids)
        cuts = B.runs(ids[order])
        at, count = order[cuts[:-1]], np.diff(cuts).view(U)
        bucket = _bucket(ids[at], buckets)
        ends = B.runs(bucket)
        for lo, hi in zip(ends[:-1], ends[1:]):
            s = lo + np.argsort(a[at[lo:hi]])
            yield pa.RecordBatch.from_pydict({"bucket": [bucket[lo]], "n": [hi - lo], "block": [_block(_steps(a[at[s]]), b[at[s]], count[s])]}, kind)

    kind = pa.schema([("bucket", pa.int64()), ("n", pa.int64()), ("block", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for whole in batches:
            for batch in B.slices(whole, most=2 << 20):
                (short, _), (ids, ok) = grams(*tokens(batch.column("text")), n)[-2:]
                before = _before(short)
                on = np.flatnonzero(ok)
                on = on[_may(sent.value[0], before[on]) & _may(sent.value[1], short[on])]
                held.append((ids[on], before[on], short[on]))
                size += len(on)
                if size >= 2_000_000:
                    yield from flush(held)
                    held, size = [], 0
        if size:
            yield from flush(held)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in B.grouped(batches, "bucket"):
            a, b, c = (np.concatenate(x) for x in zip(*(
                (np.cumsum(x, dtype=U), y, z) for x, y, z in (_unblock(d, m, 3) for d, m in zip(t.column("block").to_pylist(), t.column("n").to_pylist())))))
            ids = B.mix(B.mix(a ^ END) + b)
            order = np.argsort(ids)
            cuts = B.runs(ids[order])
            total = np.add.reduceat(c[order], cuts[:-1])
            often = total >= least
            at, total = order[cuts[:-1]][often], total[often]
            for i in range(0, len(at), 100_000):
                s = at[i:i + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (ids[s], a[s], b[s], total[i:i + 100_000])], ["id", "a", "b", "c"])
            del a, b, c, ids, order
            B.release()

    return (texts.mapInArrow(count, "bucket long, n long, block binary").repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(add, "id long, a long, b long, c long"))


def _looked_up(rows: DataFrame, column: str, table: DataFrame, hot: int) -> DataFrame:
    """Rows (a, b, ...) with the values of table (id, n, ...) for their
    ``column``; ids of n >= hot are spread over SALTS tasks."""
    often = table.filter(F.col("n") >= hot).select(F.col("id").alias(column), F.lit(True).alias("_often"))
    rows = rows.join(F.broadcast(often), column, "left").withColumn(
        "_salt", F.when(F.col("_often"), F.pmod(F.xxhash64("a", "b"), F.lit(SALTS).cast("long"))).otherwise(F.lit(0).cast("long"))).drop("_often")
    salts = F.when(F.col("n") >= hot, F.expr(f"sequence(0L, {SALTS - 1}L)")).otherwise(F.expr("array(0L)"))
    table = table.withColumn("_salt", F.explode(salts)).drop("n").withColumnRenamed("id", column)
    return rows.join(table, [column, "_salt"]).drop("_salt")


def _rest(p: Column) -> Column:
    return F.least(F.greatest(1 - F.sum(p), F.lit(1e-12)), F.lit(1.0))


def learn(train: DataFrame, depth: int = 2, least_context: float = 8, least_symbol: float = 2, gain: float = 30.0):
    """(tree, word table (h, c)) of the texts of ``train``."""
    spark = train.sparkSession
    checkpoint_base(spark)
    B.prepare(spark)
    texts = train.select("text")

    parts = []  # of the model, needed until it is written

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(path := shared_dir(spark, name))
        parts.append(path)
        return spark.read.parquet(path)

    table = stored(texts.mapInArrow(lambda it: _summed(it, lambda h, offs: h.view(np.int64)), "h long, c long")
                   .groupBy("h").agg(F.sum("c").alias("c")), "word-counts")
    total, distinct = table.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    few, least = (max(m, int(np.ceil(x * total if x < 1 else x))) for x, m in ((least_context, 4), (least_symbol, 2)))
    hot = max(1, int(np.ceil(HOT * total)))
    # counts and divergence tests, level by level; no text goes on after its end, so no context holds one
    parts.clear()  # the word table stays
    words = table.select(F.col("h").alias("id"), "c", ((F.col("c") + 0.5) / float(total + 0.5 * (distinct + 1))).alias("p"))
    shorter, entries, states = words, [], []
    p = F.col("c") / F.col("total")
    for level in range(1, depth + 1):
        contexts = shorter.filter(F.col("c") >= few)
        counted = shorter.filter(F.col("c") >= least)
        sent = spark.sparkContext.broadcast((_bits(contexts, contexts.count()), _bits(counted, counted.count())))
        found = _counted(texts, level + 1, sent, least, _buckets(spark, total))
        found = _looked_up(found, "a", contexts.select("id", F.col("c").alias("n"), F.col("c").alias("total")), hot)
        found = _looked_up(found, "b", shorter.select("id", F.col("c").alias("n"), F.col("p").alias("q")), hot)
        entries.append(stored(found, "entries"))
        sent.unpersist()
        kl = F.sum(p * F.log(p / F.col("q"))) + _rest(p) * F.log(_rest(p) / _rest(F.col("q")))
        states.append(entries[-1].groupBy(F.col("a").alias("id")).agg(
            F.max("total").alias("n"), (F.max("total") * kl >= gain).alias("good"), _rest((F.col("c") - DISCOUNT) / F.col("total")).alias("left")))
        shorter = entries[-1].select("id", "c", p.alias("p"))
    kept, needed = {}, None
    for level in range(depth, 0, -1):
        good = states[level - 1]
        if needed is not None:
            good = good.join(needed, "id", "left").withColumn("good", F.col("good") | F.coalesce("needed", F.lit(False)))
        kept[level] = stored(good.filter("good").select("id", "n", "left"), "states")
        if level > 1:
            needed = (kept[level].join(entries[level - 2].select("id", "b"), "id").select(F.col("b").alias("id")).distinct()
                      .withColumn("needed", F.lit(True)))
    # probabilities from the root on
    zero, none = F.lit(0.0), F.lit(None).cast("double")
    lower = words.select("id", F.col("c").alias("n"), F.col("p").alias("low"))
    values = [words.select("id", "c", F.log10("p").alias("base"), zero.alias("own"), zero.alias("back"))]
    for level in range(1, depth + 1):
        rows = _looked_up(entries[level - 1].select("id", "a", "b", "c", "total"), "a", kept[level], hot)
        rows = _looked_up(rows, "b", lower, hot).select("id", F.col("c").alias("n"), ((F.col("c") - DISCOUNT) / F.col("total")).alias("mine"),
                                                        (F.col("left") * F.col("low")).alias("given"))
        rows = stored(rows.select("id", "n", (F.col("mine") + F.col("given")).alias("low"), F.log10(1 + F.col("mine") / F.col("given")).alias("own")), "probabilities")
        values.append(rows.select("id", F.col("n").alias("c"), none.alias("base"), "own", zero.alias("back")))
        values.append(kept[level].select("id", F.col("n").alias("c"), none.alias("base"), zero.alias("own"), F.log10("left").alias("back")))
        lower = rows.select("id", "n", "low")
    model = values[0]
    for v in values[1:]:
        model = model.unionByName(v)
    kept = {d: np.int64(k.count()) for d, k in kept.items()}
    model = stored(model.groupBy("id").agg(F.max("c").alias("c"), F.max("base").alias("base"), F.sum("own").alias("own"), F.sum("back").alias("back")), "model")
    for path in parts[:-1]:
        _delete(spark, path)
    return SuffixTree(model, total, distinct, depth, kept), table


def _answers(buckets: int, keep: list[pa.Field]):
    """For rows sorted by (bucket, kind), the blocks of the model (kind 0)
    before those of the texts (1): sums per text; texts' own rows (2) pass."""
    names = ["rid", *(f.name for f in keep), "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, model = None, [], None
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            if (kinds == 2).any():
                yield batch.filter(pa.array(kinds == 2)).select(names)
            for i in np.flatnonzero(kinds < 2):
                bucket, n, rid, data = (batch.column(x)[i].as_py() for x in ("bucket", "n", "rid", "block"))
                if bucket != now:
                    now, parts, model = bucket, [], None
                    B.release()
                if kinds[i] == 0:
                    ids, base, v = _unblock(data, n, 3)
                    parts.append((np.cumsum(ids, dtype=U), base.view(float), v.view(float)))
                    continue
                if model is None:
                    ids, base, v = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, U), np.zeros(0), np.zeros(0))
                    order = np.argsort(ids)
                    model, parts = (ids[order], base[order], v[order]), []
                gram, owner, count = _unblock(data, n, 3)
                at = _find(model[0], np.cumsum(gram, dtype=U))
                owner, count, at = owner[at >= 0].astype(np.int64), count[at >= 0].astype(float), at[at >= 0]
                base, v, some = model[1][at], model[2][at], np.bincount(owner)
                on = np.flatnonzero(some)
                known = ~np.isnan(base)
                m = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid + on), *(pa.nulls(len(on), f.type) for f in keep), pa.nulls(len(on), pa.int64()),
                     pa.array(np.bincount(owner, count * known, m)[on].astype(np.int64)), pa.array(np.bincount(owner, count * np.where(known, base, 0.0), m)[on].astype(float)),
                     pa.array(np.bincount(owner, count * v, m)[on].astype(float))], names)
        B.release()

    return run


def scores(docs: DataFrame, tree: SuffixTree, table: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_tokens, n_known, train_tokens, base_score, score of each text."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(tree)
    buckets = _buckets(spark, tree.rows, BUCKET // 2)
    fields = [pa.field(c, to_arrow_type(docs.schema[c].dataType)) for c in keep]
    form = pa.schema([("bucket", pa.int64()), ("kind", pa.int64()), ("n", pa.int64()), ("block", pa.binary()), ("rid", pa.int64()), *fields,
                      ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def row(values: dict, n: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in form], schema=form)

    def dealt(kind: int, ids: np.ndarray, rid: int, *others: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A block of the sorted ids for each bucket."""
        cuts = B.runs(bucket := _bucket(ids, buckets))
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield row({"bucket": [bucket[lo]], "kind": [kind], "n": [hi - lo], "rid": [rid], "block": [_block(_steps(ids[lo:hi]), *(x[lo:hi].view(U) for x in others))]}, 1)

    def asked(held, begin: int) -> Iterator[pa.RecordBatch]:
        """Each n-gram of a text once, with its count."""
        gram, owner = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(gram, kind="stable")  # owners ascend
        gram, owner = gram[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])]))
        yield from dealt(1, gram[first], begin, owner[first], np.diff(np.append(first, len(gram))))

    def known(held) -> Iterator[pa.RecordBatch]:
        ids, base, v = (np.concatenate(x) for x in zip(*held))
        order = np.argsort(ids := ids.view(U))
        yield from dealt(0, ids[order], 0, base[order], v[order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rid = sent.value, TaskContext.get().partitionId() << 33
        held, size, begin = [], 0, rid
        for whole in batches:
            for b in B.slices(whole, most=2 << 20):
                h, offs = tokens(b.column("text"))
                n = b.num_rows
                text = np.repeat(np.arange(n), np.diff(offs))
                root, score, rest = model.parts(h, offs)
                on = ~np.isnan(root)
                ids = rid + np.arange(n)
                yield row({"bucket": _bucket(B.mix(ids.view(U)), buckets), "kind": np.full(n, 2), "rid": ids, **{c: b.column(c) for c in keep}, "n_tokens": np.diff(offs),
                           "n_known": np.bincount(text, on, n).astype(np.int64), "base_score": np.bincount(text, np.where(on, root, 0.0), n).astype(float),
                           "score": np.bincount(text, score, n).astype(float)}, n)
                for at, gram in rest:
                    held.append((gram, text[at] + (rid - begin)))
                    size += len(at)
                rid += n
                if size >= 1_000_000:
                    yield from asked(held, begin)
                    held, size, begin = [], 0, rid
        if size:
            yield from asked(held, begin)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            held.append([b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "base", "v")])
            size += b.num_rows
            if size >= 1_000_000:
                yield from known(held)
                held, size = [], 0
        if size:
            yield from known(held)

    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)
    told = f"rid long, {kinds}n_tokens long, n_known long, base_score double, score double"
    schema = f"bucket long, kind long, n long, block binary, {told}"
    rest = tree.model.filter(F.col("c") < tree.often).select("id", F.col("base"), (F.coalesce("base", F.lit(0.0)) + F.col("own") + F.col("back")).alias("v"))
    rows = rest.mapInArrow(shards, schema).unionByName(docs.select(*keep, "text").mapInArrow(run, schema))
    # a text's own row takes the same shuffle as its n-grams, in a bucket of its own
    own = (rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answers(buckets, fields), told).groupBy("rid").agg(
        *(F.first(c, True).alias(c) for c in (*keep, "n_tokens")), *(F.sum(c).alias(c) for c in ("n_known", "base_score", "score"))))
    unknown = (F.col("n_tokens") - F.col("n_known")) * float(tree.base(0))
    return own.select(*keep, "n_tokens", "n_known", F.lit(int(tree.total)).cast("long").alias("train_tokens"),
                      (F.col("base_score") + unknown).alias("base_score"), (F.col("score") + unknown).alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``; learnt where crc32(doc_id) mod 5 is not 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    held = F.coalesce(fold == 1, F.lit(False))
    tree, table = learn(docs.filter(~held))
    return (scores(docs.withColumn("held_out", held), tree, table, ("doc_id", "held_out"))
            .select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"))

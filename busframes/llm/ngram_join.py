"""N-gram Jaccard self-join with a token-group matrix.

Two documents link when ``100 * |A & B| >= percent * |A | B|`` for their sets
of k-word shingles. The join is exact; classes are the connected components.

1. Documents with equal sets collapse to one representative.
2. Candidates: sets that similar differ in at most K elements (K follows from
   the sizes). The hash space is cut into p > K ranges, so at least p - K of a
   pair's ranges hold the same elements. A document emits one key per range,
   without its lightest ranges (fewest elements that aren't common to many
   documents) as far as p - K - t may be left out, so that a similar pair
   shares t keys; sets of at most SMALL elements emit their subsets with the
   few deletions allowed, of which one is shared. Sizes are dealt into
   geometric classes; a document emits keys for its own class and, if a larger
   partner can be there, for the next.
3. Keys of one document go. A document with fewer than t keys of a class left
   has no partner: it goes, and with it keys that are then of one document.
   Documents with t keys under one and the same least document form groups,
   then the same is asked of the keys that cross groups, and what is left links
   groups. Components are clusters: every true link is inside one cluster, and
   passages that unlike documents share don't chain them to ever larger ones.
4. A cluster is verified in one block if its shingles fit ``block_shingles``.
   Inside a block a token-group matrix decides what is compared: documents
   ordered by their least hashes form groups, the matrix lists each token's
   groups (the groups' token unions), a query's overlap with every union comes
   from its tokens' rows, and only groups whose overlap reaches the least
   intersection that the sizes allow are opened. Members already in the
   query's component need no comparison.
5. Larger clusters are split: blocks of part of the cluster, then blocks of
   one document per component found, and finally whatever is not in the
   cluster's main component against every part. Nothing is capped or dropped.

Defined cases: null and empty texts have no shingles and link with nothing;
1 to k-1 words are one shingle; rows that repeat a doc_id share a class; rows
without doc_id link with nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.llm.graph import connected_components
from busframes.session import checkpoint_base, shared_dir

U = np.uint64
SMALL = 14
SALTS = 32
BROADCAST_IDS = 2_000_000  # 16 MB
GROUP = 16


def _bounds(percent: int) -> np.ndarray:
    """Least sizes of the size classes above SMALL."""
    out = [SMALL + 1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent), out[-1] * 51 // 50))
    return np.array(out)


def _plan(largest: int, percent: int) -> tuple[int, int, int]:
    """(ranges, how many may be left out, how many that are kept a pair shares)
    for pairs whose larger set has at most ``largest`` elements."""
    differ = 2 * largest * (100 - percent) // (100 + percent)
    shared = 2 + differ // 8
    return 2 * (differ + 1), differ + 2 - shared, shared


class Frequent:
    """Shingles that many documents hold."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(self.hashes >> U(42)).astype(np.int64)] = True

    def holds(self, s: np.ndarray) -> np.ndarray:
        out = self.seen[(s >> U(42)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            found = np.minimum(np.searchsorted(self.hashes, s[at]), len(self.hashes) - 1)
            out[at] = self.hashes[found] == s[at]
        return out


NONE = Frequent(np.zeros(0, U))


def set_keys(s: np.ndarray, percent: int, bounds: np.ndarray, frequent: Frequent = NONE) -> np.ndarray:
    """Keys of one sorted set; sets at least that similar share one."""
    return np.unique(keys_and_needs(s, percent, bounds, frequent)[0])


def keys_and_needs(s: np.ndarray, percent: int, bounds: np.ndarray, frequent: Frequent = NONE) -> tuple[np.ndarray, np.ndarray]:
    """(keys, needs) of one sorted set: of the keys with the same need, sets at
    least that similar share as many as it says, for one of the needs. Ranges
    weigh by their elements that aren't frequent, then by all: equal ranges
    weigh alike whatever ``frequent`` holds, so it changes cost, not links."""
    n, out, needs = len(s), [], []
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int32)
    mixed = B.mix(s + U(0x632BE59BD9B4E019))
    if percent * n <= 100 * SMALL:
        total = np.add.reduce(mixed)
        for d in range((100 - percent) * n // 100 + 1):
            gone = np.array([np.add.reduce(mixed[list(c)]) for c in combinations(range(n), d)], U) if d else np.zeros(1, U)
            out.append(np.unique(B.mix((total - gone) ^ U(n - d << 40))))
            needs.append(1)
    if n > SMALL:
        upto = np.concatenate([np.zeros(1, U), np.cumsum(mixed, dtype=U)])
        rare = np.concatenate([[0], np.cumsum(~frequent.holds(s))])
        own = int(np.searchsorted(bounds, n, "right")) - 1
        for c in (own, own + 1) if n * 100 >= percent * bounds[own + 1] else (own,):
            p, spare, shared = _plan(int(bounds[c + 1]) - 1, percent)
            cuts = np.searchsorted(((s >> U(32)) * U(p)) >> U(32), np.arange(p + 1).astype(U))
            weight = (rare[cuts[1:]] - rare[cuts[:-1]]) * 64 + np.minimum(np.diff(cuts), 63)
            sums = upto[cuts[1:]] - upto[cuts[:-1]]
            keys = B.mix(sums ^ B.mix((np.arange(p) + (c + 1 << 32)).astype(U)))
            # without the ``spare`` lightest; ties by key, which equal ranges share, so that the
            # greatest of a pair's equal ranges stay in both
            out.append(keys[np.lexsort((keys, weight))[spare:]])
            needs.append(shared)
    return np.concatenate(out), np.repeat(needs, [len(x) for x in out]).astype(np.int32)


def shingle_sets(column, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, offs = B.shingles(*B.hashed_words(column), k)
    out = []
    for a, b in zip(offs[:-1], offs[1:]):
        s = np.sort(h[a:b])
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out


def frequent_shingles(docs: DataFrame, k: int, sample: int = 4000, least: int = 4, most: int = 1_000_000) -> Frequent:
    """Shingles in at least ``least`` of about ``sample`` documents (chosen by
    a hash of doc_id); the ``most`` common at most. Only a hint for the keys:
    the links are the same without it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole):
                sets = shingle_sets(b.column("text"), k)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    B.prepare(docs.sparkSession)
    share = min(1_000_000, 1 + 1_000_000 * sample // max(docs.count(), 1))
    few = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)) < share).select("text")
    got = (few.mapInArrow(run, "h long").groupBy("h").count().filter(F.col("count") >= least)
           .orderBy(F.desc("count"), "h").limit(most).select("h").toArrow())
    return Frequent(got.column("h").to_numpy().view(U))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, set_hash) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole, most=1 << 20):
                sets = shingle_sets(b.column("text"), k)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())], ["doc_id", "n", "set_hash"])

    B.prepare(docs.sparkSession)
    return _texts(docs).mapInArrow(run, "doc_id long, n long, set_hash binary")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def _few(ids: DataFrame) -> DataFrame:
    """A table of ids, broadcast if its size is known to be small, so that
    texts and keys need no shuffle to be matched with it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def shared_keys(docs: DataFrame, k: int, percent: int, frequent: Frequent = NONE) -> DataFrame:
    """(run, doc, need): a row per document and key that it shares; ``run``
    numbers the keys, which are not stored, and ``need`` is as above."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(frequent)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds(percent)
        for whole in batches:
            for b in B.slices(whole, most=1 << 20):
                keys, needs = zip(*(keys_and_needs(s, percent, bounds, sent.value) for s in shingle_sets(b.column("text"), k)))
                doc = np.repeat(b.column("doc_id").to_numpy(zero_copy_only=False), [len(x) for x in keys])
                key, need = np.concatenate(keys).view(np.int64), np.concatenate(needs)
                for a in range(0, len(key), 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(x[a:a + 100_000]) for x in (key, doc, need)], ["key", "doc", "need"])

    B.prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_dir(spark, "shared-keys")
    (_texts(docs).mapInArrow(keyed, "key long, doc long, need int").repartition(parts, "key")
     .sortWithinPartitions("key", "doc").mapInArrow(_run_rows, "run long, doc long, need int").write.parquet(path))
    return spark.read.parquet(path)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys with several documents, from rows sorted by (key, doc);
    rows that repeat count once. One row is carried over."""
    run, carry, told = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40, None, False
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "doc", "need")]
        if carry is not None:
            cols = [np.concatenate([[c], x]) for c, x in zip(carry, cols)]
        key, doc, need = cols
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
        key, doc, need = key[new], doc[new], need[new]
        same = key[1:] == key[:-1]
        ids = run + np.concatenate([[0], np.cumsum(~same)])
        out = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        told, last = (told if len(key) == 1 else bool(same[-1])), told
        if last:
            out[0] = False
        yield pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(doc[out]), pa.array(need[out].astype(np.int32))], ["run", "doc", "need"])
        run, carry = int(ids[-1]), (key[-1], doc[-1], need[-1])


def _partners(rows: DataFrame) -> DataFrame:
    """Rows (run, doc, need, label), all in runs of several labels, of documents
    that have as many of them as they need. What goes leaves runs of one label,
    so this is asked again while a tenth of the rows go; the others cost only."""
    before = None
    while True:
        enough = rows.groupBy("doc", "need").agg(F.count("*").alias("n")).filter("n >= need").select("doc", "need").checkpoint()
        rows = _across(rows.join(_few(enough), ["doc", "need"], "left_semi"))
        left = rows.count()
        if not left or (before is not None and left > 0.9 * before):
            return rows
        before = left


def _across(rows: DataFrame) -> DataFrame:
    """The rows of runs with several labels."""
    run = Window.partitionBy("run")
    ends = rows.withColumns({"_min": F.min("label").over(run), "_max": F.max("label").over(run)})
    return ends.filter("_min <> _max").select("run", "doc", "need", "label").checkpoint()


def key_edges(docs: DataFrame, k: int, percent: int, frequent: Frequent = NONE) -> DataFrame:
    """Unverified edges (a, b); all similar documents are connected by them."""
    rows = _partners(shared_keys(docs, k, percent, frequent).withColumn("label", F.col("doc")))
    run = Window.partitionBy("run")
    near = (rows.withColumn("b", F.min("doc").over(run)).filter("doc <> b").groupBy("doc", "need", "b").agg(F.count("*").alias("n"))
            .filter("n >= need").select(F.col("doc").alias("a"), "b").distinct().checkpoint())
    groups = connected_components(near).select(F.col("id").alias("doc"), "component").checkpoint()
    rows = _across(rows.join(_few(groups), "doc", "left").withColumn("label", F.coalesce("component", "label")))
    far = (_partners(rows).withColumn("b", F.min("label").over(run)).filter("label <> b")
           .select(F.col("label").alias("a"), "b").distinct())
    return near.unionByName(far)


class _Union:
    """Union-find over labels."""

    def __init__(self):
        self.up: dict = {}

    def find(self, x):
        root = x
        while self.up.get(root, root) != root:
            root = self.up[root]
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


class TokenGroups:
    """Token-group matrix of sets, in groups of neighbours by least hashes."""

    def __init__(self, sets: list[np.ndarray], percent: int, size: int = GROUP):
        self.sets, self.percent = sets, percent
        order = sorted(range(len(sets)), key=lambda i: tuple(sets[i][:4].tolist()))
        self.groups = [order[a:a + size] for a in range(0, len(order), size)]
        unions = [np.unique(np.concatenate([sets[i] for i in g])) for g in self.groups]
        tokens = np.concatenate(unions) if unions else np.zeros(0, U)
        owner = np.repeat(np.arange(len(unions)), [len(u) for u in unions])
        at = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[at], owner[at]
        self.least = np.array([min(len(sets[i]) for i in g) for g in self.groups])
        self.most = np.array([max(len(sets[i]) for i in g) for g in self.groups])

    def opened(self, s: np.ndarray) -> np.ndarray:
        """Groups that can hold a set similar to s."""
        lo, hi = np.searchsorted(self.tokens, s, "left"), np.searchsorted(self.tokens, s, "right")
        overlap = np.bincount(self.owner[B.expand(lo, hi - lo)], minlength=len(self.groups))
        n, t = len(s), self.percent
        fits = (100 * self.most >= t * n) & (100 * n >= t * self.least)
        return np.flatnonzero(fits & ((100 + t) * overlap >= t * (n + np.maximum(self.least, -(-t * n // 100)))))

    def similar(self, s: np.ndarray, i: int) -> bool:
        other = self.sets[i]
        a, b = (s, other) if len(s) < len(other) else (other, s)
        if 100 * len(a) < self.percent * len(b):
            return False
        at = np.searchsorted(b, a)
        at[at == len(b)] = 0
        both = int((b[at] == a).sum())
        return 100 * both >= self.percent * (len(a) + len(b) - both)


def block_links(ids: list, labels: list, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all similar sets whose labels differ so far."""
    keep = [i for i, s in enumerate(sets) if len(s)]
    ids, labels, sets = [ids[i] for i in keep], [labels[i] for i in keep], [sets[i] for i in keep]
    if len(set(labels)) < 2:
        return []
    matrix, known, links = TokenGroups(sets, percent), _Union(), []
    for i, s in enumerate(sets):
        for g in matrix.opened(s):
            for j in matrix.groups[g]:
                if j < i and known.find(labels[i]) != known.find(labels[j]) and matrix.similar(s, j):
                    known.join(labels[i], labels[j])
                    links.append((ids[i], ids[j]))
    return links


def _verified(members: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) inside blocks; members: (doc_id, label, block)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.grouped(batches, "block"):
            links = block_links(block.column("doc_id").to_pylist(), block.column("label").to_pylist(), shingle_sets(block.column("text"), k), percent)
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs).join(_few(members.select("doc_id").distinct()), "doc_id", "left_semi")
    return (members.join(texts, "doc_id").select("block", "doc_id", "label", "text").repartition(parts, "block")
            .sortWithinPartitions("block", "doc_id").mapInArrow(run, "a long, b long"))


def _large(members: DataFrame, docs: DataFrame, k: int, percent: int, most: int) -> DataFrame:
    """Links of clusters that don't fit one block. members: (doc_id, cluster, n)."""
    spark, links = docs.sparkSession, None
    state = members.withColumn("label", F.col("doc_id")).checkpoint()
    reps, before = state, None
    while True:
        size = reps.groupBy("cluster").agg(F.sum("n").alias("w"), F.count("*").alias("c"))
        size = size.filter("c > 1").withColumn("subs", F.ceil(F.col("w") / most))
        count, split = size.agg(F.sum("c"), F.max("subs")).first()
        if not count or (before is not None and count > 0.7 * before):
            break
        before = count
        blocks = reps.join(size.select("cluster", "subs"), "cluster").select(
            "doc_id", "label", F.xxhash64("cluster", F.pmod(F.xxhash64("doc_id"), "subs")).alias("block"))
        found = _verified(blocks, docs, k, percent).checkpoint()
        links = found if links is None else links.unionByName(found).checkpoint()
        comp = connected_components(links).withColumnsRenamed({"id": "doc_id", "component": "_c"})
        state = members.join(comp, "doc_id", "left").withColumn("label", F.coalesce("_c", "doc_id")).drop("_c").checkpoint()
        reps = state.filter("label = doc_id")
        if split == 1:
            break
    # whatever is outside a cluster's main component against every part of the cluster
    sizes = state.groupBy("cluster", "label").agg(F.sum("n").alias("w"), F.count("*").alias("c"))
    main = sizes.groupBy("cluster").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("w").alias("w"), F.count("*").alias("labels"))
    main = main.filter("labels > 1").select("cluster", F.col("m.label").alias("main"), F.ceil(F.col("w") / (most / 2)).alias("subs"))
    rows = state.join(main, "cluster")
    rest = rows.filter("label <> main")
    parts = rest.groupBy("cluster").agg(F.ceil(F.sum("n") / (most / 2)).alias("parts"))
    rows = rows.join(parts, "cluster").withColumn("i", F.pmod(F.xxhash64("doc_id"), "subs")).withColumn("j", F.pmod(F.xxhash64("doc_id", F.lit(1)), "parts"))
    left = rows.withColumn("j", F.explode(F.expr("sequence(0, parts - 1)")))
    right = rows.filter("label <> main").withColumn("i", F.explode(F.expr("sequence(0, subs - 1)")))
    blocks = left.unionByName(right).select("doc_id", "label", F.xxhash64("cluster", "i", "j").alias("block")).distinct()
    last = _verified(blocks, docs, k, percent)
    return last if links is None else links.unionByName(last)


def _by_text(docs: DataFrame, several: DataFrame, k: int, percent: int, block_shingles: int) -> DataFrame:
    """(_id, component): classes where the doc_ids ``several`` have different
    texts. Each of these texts is joined under a key of its own, then the texts
    of a doc_id are linked."""
    rows = _texts(docs).filter("doc_id is not null").join(_few(several.withColumn("_s", F.lit(True))), "doc_id", "left")
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    rows = rows.withColumn("key", F.when(F.col("_s"), own).otherwise(F.col("doc_id")))
    keys = rows.filter("_s").select("key", "doc_id").distinct().checkpoint()
    found = jaccard_classes(rows.select(F.col("key").alias("doc_id"), "text"), k, percent, block_shingles)
    edges = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("a"), F.col("component_id").alias("b"))
    comp = connected_components(edges.unionByName(keys.select(F.col("key").alias("a"), F.col("doc_id").alias("b"))))
    real = comp.join(_few(keys.select(F.col("key").alias("id"))), "id", "left_anti").checkpoint()
    least = real.groupBy("component").agg(F.min("id").alias("least"))
    # the least node is a doc_id unless all doc_ids of a class lie above the keys
    least = least.filter("least <> component")
    return (real.join(_few(least), "component", "left")
            .select(F.col("id").alias("_id"), F.coalesce("least", "component").alias("component")))


def jaccard_classes(docs: DataFrame, k: int = 5, percent: int = 80, block_shingles: int = 2_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    spark = docs.sparkSession
    checkpoint_base(spark)
    path = shared_dir(spark, "shingle-signatures")
    signatures(docs, k).write.parquet(path)
    sign = spark.read.parquet(path)
    plain = sign.select("doc_id", "n", "set_hash").filter("n > 0 and doc_id is not null")
    several = plain.groupBy("doc_id").agg((F.min("set_hash") != F.max("set_hash")).alias("s")).filter("s").select("doc_id").checkpoint()
    if several.limit(1).count():
        comp = _by_text(docs, several, k, percent, block_shingles)
        return (sign.join(comp, F.col("doc_id") == F.col("_id"), "left")
                .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))
    # copies meet in salted groups first: a set with a third of all rows is spread over SALTS tasks
    salted = plain.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = salted.groupBy("set_hash", "n", "salt").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")).checkpoint()
    first = some.groupBy("set_hash", "n").agg(F.min("rep").alias("least"), F.sum("copies").alias("all")).filter(F.col("all") > 1)
    near = salted.join(some.filter("copies > 1"), ["set_hash", "n", "salt"]).filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    far = some.join(first, ["set_hash", "n"]).filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    copies = near.unionByName(far).checkpoint()
    gone = copies.select(F.col("a").alias("doc_id")).distinct()
    sole = _texts(docs).filter("doc_id is not null").join(_few(gone), "doc_id", "left_anti")
    edges = key_edges(sole, k, percent, frequent_shingles(docs, k))
    clusters = connected_components(edges).select(F.col("id").alias("doc_id"), F.col("component").alias("cluster"))
    members = clusters.join(plain.groupBy("doc_id").agg(F.sum("n").alias("n")), "doc_id").checkpoint()
    weight = members.groupBy("cluster").agg(F.sum("n").alias("w"))
    fit = members.join(weight.filter(F.col("w") <= block_shingles), "cluster").select("doc_id", F.col("doc_id").alias("label"), F.col("cluster").alias("block"))
    links = _verified(fit, docs, k, percent)
    large = members.join(weight.filter(F.col("w") > block_shingles).select("cluster"), "cluster").checkpoint()
    if large.limit(1).count():
        links = links.unionByName(_large(large, docs, k, percent, block_shingles))
    comp = connected_components(links.unionByName(copies)).withColumnRenamed("id", "_id")
    return (sign.join(comp, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")))


def _one_row_each(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(docs with ``__key``, (key, doc_id) of the rows with a key of their own).

    Rows of one doc_id and text become one row. The key is the doc_id; rows
    whose doc_id has several texts, and rows without doc_id that have a word,
    get a hash of doc_id and text above 2 ** 62. Only these rows and those that
    repeat are shuffled with their texts, reduced in the task first."""
    spark = docs.sparkSession
    checkpoint_base(spark)
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    digest = docs.select("doc_id", F.xxhash64("text").alias("t")).groupBy("doc_id").agg(
        F.count("*").alias("n"), (F.min("t") != F.max("t")).alias("__many"))
    again = digest.filter("n > 1 and doc_id is not null").select(F.col("doc_id").alias("__id"), "__many").checkpoint()
    marked = docs.join(_few(again), F.col("doc_id") == F.col("__id"), "left").drop("__id")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = marked.withColumn("__key", F.when(F.coalesce("__many", F.col("doc_id").isNull() & worded), own).otherwise(F.col("doc_id").cast("long")))
    odd = F.col("__many").isNotNull() | (F.col("doc_id").isNull() & worded)
    path = shared_dir(spark, "repeated-rows")
    marked.filter(odd).drop("__many").dropDuplicates(["__key"]).write.parquet(path)
    once = spark.read.schema(marked.drop("__many").schema).parquet(path)
    keys = once.filter(F.col("doc_id").isNull() | (F.col("__key") != F.col("doc_id"))).select("__key", "doc_id")
    return marked.filter(~odd).drop("__many").unionByName(once), keys if keys.limit(1).count() else None


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one row (the least doc_id) of each class of
    near-duplicates by five-word shingles at 0.8 stays. Rows that repeat a
    doc_id with another text, or have none, are rows of their own here; rows
    without any word link with nothing, but one of each doc_id and text stays."""
    rows, keys = _one_row_each(docs)
    classes = jaccard_classes(rows.select(F.col("__key").alias("doc_id"), "text")).filter("doc_id is not null").select("doc_id", "component_id")
    if keys is None:
        gone = classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
    else:
        classes = classes.checkpoint()
        # a class's least key is not its least doc_id where that row has a key of its own
        least = (classes.join(keys.select(F.col("__key").alias("doc_id"), F.col("doc_id").alias("id")), "doc_id").groupBy("component_id")
                 .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")).alias("m")))
        swap = (least.join(keys.select(F.col("__key").alias("component_id"), F.lit(True).alias("own")), "component_id", "left")
                .filter("component_id <> m.doc_id and (own or m.id < component_id)").select("component_id", F.col("m.doc_id").alias("best")))
        gone = (classes.filter("doc_id <> component_id").select(F.col("doc_id").alias("__gone"))
                .join(swap.select(F.col("best").alias("__gone")), "__gone", "left_anti").unionByName(swap.select(F.col("component_id").alias("__gone"))))
    gone = gone.distinct().checkpoint()
    return rows.join(_few(gone), F.col("__key") == F.col("__gone"), "left_anti").select(*docs.columns)


def query(spark, sf_dir: str) -> DataFrame:
    """Classes of ``documents`` by three-word shingles at 0.9."""
    return jaccard_classes(spark.read.parquet(f"{sf_dir}/documents.parquet"), k=3, percent=90)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, list_slice(words, i, i + 2) AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
  UNION ALL SELECT doc_id, words FROM w WHERE len(words) BETWEEN 1 AND 2)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
same AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON r.other = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(r.other), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach r USING (doc_id) GROUP BY w.doc_id, n.n"""

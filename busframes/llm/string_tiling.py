"""Benchmark decontamination by greedy string tiling.

Documents meet test items by shared seeds (``min_match`` words in a row). For
each such pair, running Karp-Rabin greedy string tiling marks the longest
matches that don't overlap earlier ones, longest first, down to ``min_match``
words. The share of the item's words under tiles is its coverage; a document
is contaminated if it covers ``threshold`` of some item. Tiles may stand in any
order, so reordered passages are caught.

Items travel to the tasks in slabs of at most ``slab_words`` words (a broadcast
of proven size; a benchmark of any size is a sequence of slabs, each against
all documents). Documents are never shuffled, and the tiling of a pair looks
only at the words around its seeds.

Defined cases: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; null and
empty texts have no match; items with fewer than ``min_match`` words match
nothing; of items covered alike the least item_id is reported; repeated rows
are judged alike; texts of any length are read whole, other columns stay;
empty tables give no rows, an empty benchmark no match.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.session import checkpoint_base

U = np.uint64
MULT = U(0xD6E8FEB86659FD93)
HITS = 1 << 20


def karp_rabin(words: np.ndarray, size: int) -> np.ndarray:
    """Rolling hashes of all runs of ``size`` words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    h = np.zeros(n, U)
    for j in range(size):
        h = h * MULT + words[j:n + j]
    return B.mix(h)


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Starts of runs of ``size`` words without a marked word."""
    upto = np.concatenate([[0], np.cumsum(marked)])
    return np.flatnonzero(upto[size:] == upto[:len(upto) - size]) if len(marked) >= size else np.zeros(0, np.int64)


def _matches(a: np.ndarray, b: np.ndarray, used_a: np.ndarray, used_b: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(length, start in a, start in b) of all maximal unmarked matches of at
    least ``size`` words: runs of equal hashes along a diagonal. Equal hashes
    are gone through HITS at a time and only a match's ends are kept, so
    repetitive texts need no more memory than they have matches."""
    at_a, at_b = _free(used_a, size), _free(used_b, size)
    if not len(at_a) or not len(at_b):
        return []
    free_a, free_b = np.zeros(len(a) + 1, bool), np.zeros(len(b) + 1, bool)
    free_a[at_a] = free_b[at_b] = True
    ha, hb = karp_rabin(a, size)[at_a], karp_rabin(b, size)[at_b]
    order = np.argsort(ha, kind="stable")
    ha, at_a = ha[order], at_a[order]
    lo, hi = np.searchsorted(ha, hb, "left"), np.searchsorted(ha, hb, "right")
    some = np.flatnonzero(hi > lo)
    lo, count, at_b = lo[some], (hi - lo)[some], at_b[some]
    upto, ends = np.cumsum(count), ([], [])
    x = 0
    while x < len(at_b):
        z = max(x + 1, int(np.searchsorted(upto, upto[x] - count[x] + HITS, "right")))
        i, j = at_a[B.expand(lo[x:z], count[x:z])], np.repeat(at_b[x:z], count[x:z])
        x = z
        # a match goes on where the words beside it are equal and unmarked
        before = (i > 0) & (j > 0) & free_a[i - 1] & free_b[j - 1] & (a[i - 1] == b[j - 1])
        after = free_a[i + 1] & free_b[j + 1]
        after[after] = a[i[after] + size] == b[j[after] + size]
        for to, on in zip(ends, (~before, ~after)):
            to.append(np.stack([j[on] - i[on], i[on]]))
    (diagonal, first), (_, last) = (m[:, np.lexsort((m[1], m[0]))] for m in (np.concatenate(e, 1) if e else np.zeros((2, 0), np.int64) for e in ends))
    return list(zip((last - first + size).tolist(), first.tolist(), (first + diagonal).tolist()))


def greedy_tiles(a: np.ndarray, b: np.ndarray, min_match: int, first_size: int = 20) -> list[tuple[int, int, int]]:
    """Tiles (length, start in a, start in b), longest matches first."""
    used_a, used_b, tiles = np.zeros(len(a), bool), np.zeros(len(b), bool), []
    size = max(min_match, first_size)
    while True:
        found = _matches(a, b, used_a, used_b, size)
        longest = max((m[0] for m in found), default=0)
        if longest > 2 * size:  # begin again with runs of that length
            size = longest
            continue
        queue = [(-n, i, j) for n, i, j in found]
        heapify(queue)
        while queue:
            n, i, j = heappop(queue)
            busy = used_a[i:i - n] | used_b[j:j - n]
            if not busy.any():
                used_a[i:i - n] = used_b[j:j - n] = True
                tiles.append((-n, i, j))
                continue
            # what is left of it waits for its turn
            cuts = np.flatnonzero(np.diff(np.concatenate([[1], busy, [1]]).astype(np.int8)))
            for s, e in zip(cuts[::2].tolist(), cuts[1::2].tolist()):
                if e - s >= size:
                    heappush(queue, (s - e, i + s, j + s))
        if size == min_match:
            return tiles
        size = size // 2 if size > 2 * min_match else min_match


class Items:
    """Test items with a seed index."""

    def __init__(self, ids: list[int], texts: list[str], min_match: int):
        h, offs = B.hashed_words(pa.array(texts, pa.string()))
        self.min_match, self.ids = min_match, ids
        self.words = [h[a:b] for a, b in zip(offs[:-1], offs[1:])]
        seeds = [karp_rabin(w, min_match) for w in self.words]
        seed = np.concatenate(seeds) if seeds else np.zeros(0, U)
        item = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        order = np.lexsort((item, seed))
        seed, item = seed[order], item[order]
        new = np.ones(len(seed), bool)  # a seed that an item repeats finds it once
        new[1:] = (seed[1:] != seed[:-1]) | (item[1:] != item[:-1])
        self.seed, self.item = seed[new], item[new]
        self.known = np.zeros(1 << 22, bool)
        self.known[(self.seed >> U(42)).astype(np.int64)] = True

    def tiled(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item_id, coverage, tiles, longest tile) of each item that shares a
        seed with the words of a document."""
        h = karp_rabin(words, self.min_match)
        at = np.flatnonzero(self.known[(h >> U(42)).astype(np.int64)])
        if not len(at):
            return []
        lo, hi = np.searchsorted(self.seed, h[at], "left"), np.searchsorted(self.seed, h[at], "right")
        item, at = self.item[B.expand(lo, hi - lo)], np.repeat(at, hi - lo)
        out = []
        for x in np.unique(item):
            near = np.unique(at[item == x][:, None] + np.arange(self.min_match))
            # words beside each other here but not in the document must not match across the gap
            gap = np.flatnonzero(np.diff(near) > 1) + 1
            part = np.insert(words[near], gap, B.mix(np.arange(len(gap)).astype(U) + U(0xA5A5A5A5)))
            tiles = greedy_tiles(self.words[x], part, self.min_match)
            out.append((self.ids[x], sum(t[0] for t in tiles) / len(self.words[x]), len(tiles), max(t[0] for t in tiles)))
        return out


def _slabs(benchmark: DataFrame, slab_words: int) -> Iterator[tuple[list[int], list[str]]]:
    """Items in runs of at most slab_words words (one item at least)."""
    ids, texts, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null").toLocalIterator():
        n = len(row["text"]) // 2 + 1
        if ids and size + n > slab_words:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids, texts, size = [*ids, row["item_id"]], [*texts, row["text"]], size + n
    yield ids, texts


def tiled_pairs(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, slab_words: int = 4_000_000) -> DataFrame:
    """The columns of docs and ``tiled``: an array of (item_id, coverage,
    tiles, longest) for every item that shares a seed with the document."""
    spark, kind = docs.sparkSession, "array<struct<item_id: long, coverage: double, tiles: long, longest: long>>"
    B.prepare(spark)
    out = docs.withColumn("tiled", F.array().cast(kind))
    for ids, texts in _slabs(benchmark, slab_words):
        sent = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = Items(*sent.value, min_match)
            for whole in batches:
                for b in B.slices(whole, most=1 << 20):
                    h, offs = B.hashed_words(b.column("text"))
                    found = []
                    for x, y, old in zip(offs[:-1], offs[1:], b.column("tiled").to_pylist()):
                        found.append(old + [dict(zip(("item_id", "coverage", "tiles", "longest"), t)) for t in items.tiled(h[x:y])])
                    at = b.schema.get_field_index("tiled")
                    yield b.set_column(at, b.schema.field(at), pa.array(found, b.schema.field(at).type))

        out = out.mapInArrow(run, out.schema)
    return out


def _worst(threshold: float):
    """Best covered item first, the least item_id among equals."""
    ranked = F.array_sort(F.transform("tiled", lambda t: F.struct((-t["coverage"]).alias("c"), t["item_id"].alias("item_id"), t["tiles"].alias("tiles"))))
    return F.get(ranked, 0), F.filter("tiled", lambda t: t["coverage"] >= threshold)


def contamination(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.8) -> DataFrame:
    """doc_id, contaminated, item_id (best covered), coverage, n_tiles,
    n_candidates, n_items of every document."""
    best, over = _worst(threshold)
    rows = tiled_pairs(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, min_match)
    return (rows.select("doc_id", best.alias("b"), F.size(over).cast("long").alias("n_items"), F.size("tiled").cast("long").alias("n_candidates"))
            .select("doc_id", (F.col("n_items") > 0).alias("contaminated"), "b.item_id", F.coalesce(-F.col("b.c"), F.lit(0.0)).alias("coverage"),
                    F.coalesce("b.tiles", F.lit(0)).cast("long").alias("n_tiles"), "n_candidates", "n_items"))


def drop_contaminated(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: contaminated documents go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    _, over = _worst(0.8)
    return tiled_pairs(docs, benchmark).filter(F.size(over) == 0).drop("tiled")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all of ``benchmark``."""
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

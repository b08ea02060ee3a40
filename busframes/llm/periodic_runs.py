"""Runs (maximal repetitions) of words by Baier's grouping.

A run is a stretch of consecutive words with smallest period q, at least 2q
long, that no neighbouring word extends keeping period q. By the runs theorem
each run holds a Lyndon root that is the longest Lyndon word at its start under
the order of the words or under the reverse one. Phase one of Baier's suffix
sorter (suffixes grouped by a common context, groups taken from the highest
down, each lengthening the contexts right before it) ends with every suffix in
the group of its longest Lyndon prefix, so it yields both Lyndon arrays without
a suffix array. Every root is then extended to both sides through longest
common extensions (polynomial hashes, galloping then halving) into its run.

A run of ``least`` words or more repeats some stretch of ``least // 2`` words
at distance q, and such stretches cover all of it; so only what those cover is
grouped, which leaves plain prose to whole-array operations. The words of a
task's slice are numbers (64-bit hashes); grouping and extension are linear or
n log n in the covered words, whatever the periods.

Everything happens in the task that reads the text: no shuffle. Defined cases:
null and empty texts have no words and no runs; white space beyond one blank
is no part of ``collapsed``; texts of any length are handled whole; repeated
rows count alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B

U = np.uint64
#: primes below 2**31 and bases of the extension hashes
PRIMES = ((2147483647, 911382323), (2147483629, 972663749))


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place; ranks are 0 to m-1,
    all in use (a prefix comes before what it begins)."""
    n, m = len(ranks), max(ranks, default=-1) + 1
    group, context = list(ranks), [1] * m
    members: list[list[int]] = [[] for _ in range(m)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    below, above = list(range(-1, m - 1)), list(range(1, m + 1))
    back = list(range(-1, n - 1))  # all between back[i] and i lie in groups done
    done = bytearray(n)
    g = m - 1
    while g >= 0:
        here = [i for i in members[g] if group[i] == g]
        members[g] = []
        for i in here:
            done[i] = 1
        times: dict[int, int] = {}
        for i in here:
            j = back[i]
            while j >= 0 and done[j]:
                j = back[j]
            while i != j:  # the way is short from now on
                back[i], i = j, back[i]
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        parts: dict[tuple[int, int], list[int]] = {}
        for j, c in times.items():
            parts.setdefault((c, group[j]), []).append(j)
        for c, old in sorted(parts, reverse=True):
            new = len(members)
            members.append(parts[c, old])
            context.append(context[old] + c * context[g])
            below.append(old)
            above.append(above[old])
            below[above[old]] = new
            above[old] = new
            for j in members[new]:
                group[j] = new
        g = below[g]
    return [context[x] for x in group]


class Extensions:
    """Longest common extensions of pairs of places, by whole arrays."""

    def __init__(self, values: np.ndarray):
        self.values, self.sides = values, []
        for p, base in PRIMES:
            power = np.ones(1, U)
            while len(power) <= len(values):
                step = power[-1] * U(base) % U(p)
                power = np.concatenate([power, power * step % U(p)])
            power = power[:len(values) + 1]
            terms = values % U(p) * power[:-1] % U(p)
            self.sides.append((U(p), power, np.concatenate([np.zeros(1, U), np.cumsum(terms) % U(p)])))

    def equal(self, i: np.ndarray, j: np.ndarray, size: np.ndarray) -> np.ndarray:
        """values[i:i+size] == values[j:j+size], for i <= j."""
        out = np.ones(len(i), bool)
        for p, power, sums in self.sides:
            a, b = (sums[i + size] + p - sums[i]) % p, (sums[j + size] + p - sums[j]) % p
            out &= a * power[j - i] % p == b
        return out

    def reach(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, left: bool = False) -> np.ndarray:
        """How far the words from i and j on are equal, at most ``most``;
        ``left``: the words before i and j, going left."""
        def same(at, size):
            return self.equal(i[at] - size, j[at] - size, size) if left else self.equal(i[at], j[at], size)

        lo, hi = np.zeros(len(i), np.int64), most.copy()
        back = 1 if left else 0
        on = np.flatnonzero(most > 0)
        first = self.values[i[on] - back] == self.values[j[on] - back]
        hi[on[~first]] = 0
        on = on[first]
        lo[on] = 1
        step = 2
        while len(on := on[hi[on] > lo[on]]):  # gallop
            size = np.minimum(step, hi[on])
            good = same(on, size)
            lo[on[good]] = size[good]
            hi[on[~good]] = size[~good] - 1
            on, step = on[good], step * 2
        while len(on := np.flatnonzero(hi > lo)):  # halve
            size = (lo[on] + hi[on] + 1) // 2
            good = same(on, size)
            lo[on[good]] = size[good]
            hi[on[~good]] = size[~good] - 1
        return lo


def stretches(h: np.ndarray, word_offs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the stretches that repeated runs of least // 2 words
    cover, where a run of ``least`` words or more can lie."""
    k = max(1, least // 2)
    n = np.diff(word_offs)
    count = np.maximum(n - k + 1, 0)
    at = B.expand(word_offs[:-1], count)
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = B.mix(np.repeat(np.arange(len(n)), count).astype(U))
    for j in range(k):
        key = B.mix(key + h[at + j])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + k, -1)
    inside = np.cumsum(cover)[:-1] > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = word_offs[1:-1]  # a stretch ends with its text
    edge = edge[(edge > 0) & (edge < len(h))]
    first[edge], last[edge - 1] = inside[edge], inside[edge - 1]
    a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
    on = b - a >= least
    return a[on], b[on]


def find_runs(h: np.ndarray, word_offs: np.ndarray, least: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of ``least`` words or more in the
    texts h[word_offs[t]:word_offs[t + 1]], by start, then period."""
    a, b = stretches(h, word_offs, least)
    none = np.zeros(0, np.int64)
    if not len(a):
        return none, none, none
    place = B.expand(a, b - a)
    values = h[place]
    offs = np.concatenate([[0], np.cumsum(b - a)])
    up, down = [], []
    for x, y in zip(offs[:-1], offs[1:]):
        _, rank = np.unique(values[x:y], return_inverse=True)
        up += lyndon_lengths(rank.tolist())
        down += lyndon_lengths((rank.max() - rank).tolist())
    seg = np.repeat(np.arange(len(a)), b - a)
    i = np.concatenate([np.arange(len(values))] * 2)
    period = np.array(up + down, np.int64)
    seg = np.concatenate([seg, seg])
    j = i + period
    ext = Extensions(values)
    right = ext.reach(i, j, offs[seg + 1] - j)
    left = ext.reach(i, j, i - offs[seg], left=True)
    size = left + period + right
    on = (size >= 2 * period) & (size >= least)
    start, size, period = place[i[on] - left[on]], size[on], period[on]
    order = np.lexsort((period, start))
    start, size, period = start[order], size[order], period[order]
    new = np.ones(len(start), bool)  # roots of one run give it alike
    new[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    return start[new], size[new], period[new]


def _rows(text: pa.Array, least: int):
    """(words, run offsets, start, length, period, collapsed texts)."""
    buf, offs = B.text_buffer(text)
    start, size, word_offs = B.words(buf, offs)
    at, length, period = find_runs(B.hash_spans(buf, start, size), word_offs, least)
    gone = np.zeros(len(start) + 1, np.int64)
    np.add.at(gone, at + period, 1)
    np.add.at(gone, at + length, -1)
    gone = np.cumsum(gone)[:-1] > 0
    lost = np.concatenate([[0], np.cumsum(gone)])
    collapsed = []
    for x, y, v, w in zip(offs[:-1].tolist(), offs[1:].tolist(), word_offs[:-1].tolist(), word_offs[1:].tolist()):
        words = buf[x:y].tobytes().split()
        if lost[w] > lost[v]:
            words = [words[k] for k in np.flatnonzero(~gone[v:w]).tolist()]
        collapsed.append(b" ".join(words))
    return np.diff(word_offs), np.searchsorted(at, word_offs), at - word_offs[np.searchsorted(word_offs, at, "right") - 1], length, period, collapsed


def periodic_runs(docs: DataFrame, least: int = 12, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_words, runs (array of start, length, period in words, by start,
    then period) and collapsed (each run's words after its first period
    dropped, the others joined by one space) of every text."""
    B.prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole):
                n, offs, start, length, period, collapsed = _rows(b.column("text"), least)
                runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offs, pa.int32()), runs),
                     pa.array(collapsed, pa.binary()).cast(pa.string())],
                    [*keep, "n_words", "runs", "collapsed"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*keep, "text").mapInArrow(
        run, ", ".join(f"`{c}` {kinds[c]}" for c in keep)
        + ", n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def _with_periods() -> Column:
    """The text; of every tenth document (by the crc32 of its id) the words
    from some place on repeat with some period."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")

    def edit(s: Column) -> Column:
        w, g = s["w"], F.floor(h / 10)
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.concat(F.slice(w, 1, a), F.transform(F.sequence(a, n - 1), lambda i: F.get(w, a + (i - a) % p))), " ")

    edited = F.transform(F.array(F.struct(words.alias("w"))), lambda s: F.when(F.size(s["w"]) > 0, edit(s)))[0]
    return F.when(h % 10 == 0, edited).otherwise(F.col("text"))


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``, some made periodic; digests of runs and of what is
    left of each text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = periodic_runs(docs.select("doc_id", _with_periods().alias("text")))
    # greatest length, then smallest start, then smallest period
    best = F.get(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))), 0)
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period")))), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select("doc_id", "n_runs", F.col("best.start").alias("start"), (-F.col("best.l")).alias("length"), F.col("best.period").alias("period"),
                       F.floor(-1000 * F.col("best.l") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

"""Toxicity scores by a factorization machine over hashed terms.

Terms of a text: its words (A-Z lower-cased, trailing punctuation cut) and
their first 4 and 5 bytes, hashed to TERM_BITS bits, each present or not. The
machine adds a weight per term and, per pair of terms, the product of their
factor vectors, so that pairs such as an insult with a group mention count
beyond their parts.

Training uses a sample of at most ``sample`` labelled rows (documented bound;
chosen by a hash of doc_id). Two kinds of terms in at least ``min_docs`` of
them are kept: those whose share of toxic texts departs from the whole by
``min_z`` standard deviations, the ``max_terms`` farthest at most; and those
of pairs whose toxic share departs by ``pair_z`` from what the two add up to,
looked for among the ``pair_terms`` terms that divide the sample most evenly.
So a pair is found even if each of its terms is neutral alone. Weights and
factors are fitted in numpy, the strongest pairs' factors from where their
counts put them. Scoring reads every whole text in Arrow batches.

Defined cases: null and empty texts have no term and get the machine's bias;
of several labels of a document the highest counts; texts repeated score
alike; without labelled rows of both kinds every score is the share of toxic
labels; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.session import checkpoint_base

U = np.uint64
TERM_BITS = 32
#: bytes that end a word's own text: .,;:!?()[]{}"'*#&%$
_TRAILING = np.zeros(256, bool)
_TRAILING[[ord(c) for c in ".,;:!?()[]{}\"'*#&%$"]] = True


def terms(column) -> tuple[np.ndarray, np.ndarray]:
    """(hashed terms, text of each), every token's terms in turn."""
    buf, offs = B.text_buffer(column, lower=True)
    start, size, word_offs = B.words(buf, offs)
    while len(start):
        cut = np.flatnonzero((size > 1) & _TRAILING[buf[start + size - 1]])
        if not len(cut):
            break
        size[cut] -= 1
    text = np.repeat(np.arange(len(column)), np.diff(word_offs))
    out = [B.hash_spans(buf, start, size)]
    owner = [text]
    for n in (4, 5):
        on = np.flatnonzero(size > n)
        out.append(B.mix(B.hash_spans(buf, start[on], np.full(len(on), n)) + U(n)))
        owner.append(text[on])
    return (np.concatenate(out) >> U(64 - TERM_BITS)).astype(np.int64), np.concatenate(owner)


def _distinct(term: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((term, text))
    term, text = term[order], text[order]
    on = np.concatenate([[True], (term[1:] != term[:-1]) | (text[1:] != text[:-1])]) if len(term) else np.zeros(0, bool)
    return term[on], text[on]


class FactorizationMachine:
    def __init__(self, terms_: np.ndarray, factors: int = 8, seed: int = 5):
        self.terms = np.sort(terms_)
        self.bias, n = np.zeros(1), len(terms_)
        self.weight = np.zeros(n)
        self.factor = np.random.default_rng(seed).normal(size=(n, factors)) * 0.05
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.terms >> (TERM_BITS - 16)] = True

    def margin(self, x: np.ndarray) -> np.ndarray:
        """x: texts by terms, 0 or 1."""
        s = x @ self.factor
        return self.bias + x @ self.weight + 0.5 * ((s * s).sum(1) - x @ (self.factor ** 2).sum(1))

    def seed(self, pairs: list[tuple[int, int, float]]) -> None:
        """Begin with the interactions (position, position, log odds) of the
        strongest pairs, one to a factor."""
        for f, (i, j, odds) in enumerate(pairs[:self.factor.shape[1]]):
            a = min(2.0, abs(odds) ** 0.5)
            self.factor[i, f], self.factor[j, f] = a, a * np.sign(odds)
            self.weight[[i, j]] -= 0.5 * a * a * np.sign(odds)

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.02, l2: float = 1e-4, seed: int = 3) -> FactorizationMachine:
        """rows: positions of each text's terms."""
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.bias[:] = np.log(share / (1 - share))
        r, step = np.random.default_rng(seed), 0
        params = [self.weight, self.factor, self.bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for epoch in range(epochs):
            order = r.permutation(len(y))
            for a in range(0, len(y), batch):
                at, step = order[a:a + batch], step + 1
                x = np.zeros((len(at), len(self.terms)))
                for i, k in enumerate(at):
                    x[i, rows[k]] = 1
                e = (1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30))) - y[at]) / len(at)
                gw = x.T @ e
                grads = [gw + l2 * self.weight, x.T @ (e[:, None] * (x @ self.factor)) - self.factor * gw[:, None] + l2 * self.factor, e.sum(keepdims=True)]
                lr = rate * (1 - 0.9 * epoch / epochs)
                for p, g, mi, vi in zip(params, grads, m, v):
                    mi += 0.1 * (g - mi)
                    vi += 0.01 * (g * g - vi)
                    p -= lr * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.99 ** step)) + 1e-8)
        return self

    def present(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(position of a kept term, text), each pair once."""
        term, text = terms(column)
        on = self.seen[term >> (TERM_BITS - 16)]
        term, text = term[on], text[on]
        if not len(self.terms):
            return term[:0], text[:0]
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        on = self.terms[at] == term
        return _distinct(at[on], text[on])

    def score(self, column) -> np.ndarray:
        at, text = self.present(column)
        n = len(column)
        out = self.bias + np.bincount(text, self.weight[at], n)
        for f in range(self.factor.shape[1]):
            v = self.factor[at, f]
            out += 0.5 * (np.bincount(text, v, n) ** 2 - np.bincount(text, v * v, n))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def interacting(rows: list[np.ndarray], y: np.ndarray, wide: np.ndarray, min_docs: int, min_z: float) -> list[tuple[int, int, float]]:
    """Pairs of the positions ``wide`` whose toxic share departs from what the
    two add up to, by falling |z|: (position, position, log odds beyond the
    sum). Each of the four cases of a pair needs ``min_docs`` texts."""
    n, place = len(y), np.full(max(int(wide.max(initial=-1)), *(int(r.max(initial=-1)) for r in rows), -1) + 1, -1)
    place[wide] = np.arange(len(wide))
    x = np.zeros((n, len(wide)), np.float32)
    for i, r in enumerate(rows):
        at = place[r]
        x[i, at[at >= 0]] = 1
    both, toxic = x.T @ x, x.T @ (x * y[:, None].astype(np.float32))
    one, one_toxic = np.diag(both), np.diag(toxic)
    counts = [both, one[:, None] - both, one[None] - both, n - one[:, None] - one[None] + both]
    hits = [toxic, one_toxic[:, None] - toxic, one_toxic[None] - toxic, y.sum() - one_toxic[:, None] - one_toxic[None] + toxic]
    sign = (1, -1, -1, 1)
    share = y.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        beyond = sum(s * h / c for s, h, c in zip(sign, hits, counts))
        z = beyond / np.sqrt(share * (1 - share) * sum(1 / c for c in counts))
    z[np.min(counts, axis=0) < min_docs] = 0
    i, j = np.nonzero(np.triu(np.abs(np.nan_to_num(z)) >= min_z, 1))
    order = np.lexsort((j, i, -np.abs(z[i, j])))
    rates = [(h + 0.5) / (c + 1) for h, c in zip(hits, counts)]
    odds = sum(s * np.log(r / (1 - r)) for s, r in zip(sign, rates))
    return [(int(wide[a]), int(wide[b]), float(odds[a, b])) for a, b in zip(i[order], j[order])]


def learn(docs: DataFrame, labels: DataFrame, sample: int = 20_000, min_docs: int = 4, min_z: float = 3.0, max_terms: int = 4096,
          pair_terms: int = 1024, pair_z: float = 5.5) -> FactorizationMachine:
    """docs (doc_id, text), labels (doc_id, toxic)."""
    spark = docs.sparkSession
    checkpoint_base(spark)
    B.prepare(spark)
    rows = labels.filter("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    n = rows.count()
    few = rows.filter(h < min(1_000_000, 1 + int(1_250_000 * sample / max(n, 1)))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = few.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).toArrow()
    chosen = spark.createDataFrame(chosen, "doc_id long, toxic int")  # at most ``sample`` rows of 12 bytes
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    size, toxic = texts.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < size:
        empty = FactorizationMachine(np.zeros(0, np.int64))
        share = np.clip(toxic / size if size else 0.0, 1e-6, 1 - 1e-6)
        empty.bias[:] = np.log(share / (1 - share))
        return empty

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole):
                term, text = _distinct(*terms(b.column("text")))
                y = b.column("toxic").to_numpy()[text]
                term, back = np.unique(term, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.bincount(back, minlength=len(term))), pa.array(np.bincount(back, y, len(term)).astype(np.int64))], ["term", "n", "t"])

    share = toxic / size
    z = F.abs(F.col("t") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
    known = (texts.mapInArrow(count, "term long, n long, t long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
             .filter(F.col("n") >= min_docs).checkpoint())
    single = known.withColumn("z", z).filter(F.col("z") >= min_z).orderBy(F.desc("z"), "term").limit(max_terms).toArrow().column("term").to_numpy()
    even = known.orderBy(F.desc(F.col("n") * (size - F.col("n"))), "term").limit(pair_terms).toArrow().column("term").to_numpy()
    machine = FactorizationMachine(np.union1d(single, even))
    sent = spark.sparkContext.broadcast(machine)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole):
                at, text = sent.value.present(b.column("text"))
                cut = np.searchsorted(text, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"), pa.ListArray.from_arrays(pa.array(cut), pa.array(at, pa.int64()))], ["doc_id", "toxic", "at"])

    got = texts.mapInArrow(rows_of, "doc_id long, toxic int, at array<long>").toArrow().sort_by("doc_id")
    at, y = [np.array(x, np.int64) for x in got.column("at").to_pylist()], got.column("toxic").to_numpy().astype(float)
    pairs = interacting(at, y, np.searchsorted(machine.terms, np.sort(even)), min_docs, pair_z)
    kept = np.union1d(np.searchsorted(machine.terms, single), np.array([x for p in pairs[:max_terms] for x in p[:2]], np.int64)).astype(np.int64)
    place = np.full(len(machine.terms), -1)
    place[kept] = np.arange(len(kept))
    fitted = FactorizationMachine(machine.terms[kept])
    fitted.seed([(place[i], place[j], odds) for i, j, odds in pairs[:max_terms]])
    steps = -(-len(y) // 256)
    return fitted.fit([place[r][place[r] >= 0] for r in at], y, epochs=max(12, -(-600 // steps)))


def scored(docs: DataFrame, machine: FactorizationMachine, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole, most=2 << 20):
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(sent.value.score(b.column("text")))], [*keep, "score"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", score double")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``; labels learnt where crc32(doc_id) mod 4 is not 2."""
    fold = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    machine = learn(docs, labels.filter(fold() != 2))
    return scored(docs, machine).select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))

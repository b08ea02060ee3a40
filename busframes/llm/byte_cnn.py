"""Language identification by a byte convolutional network.

Filters of several widths over bytes (A-Z lower-cased), max pooling over a
fixed-length window and a softmax layer; trained in numpy on a bounded sample
of labelled rows, applied in Arrow batches to every window of every whole
text. The logits of a text's windows are averaged by their letters.

Over one-hot bytes a filter of width w is a sum of w table rows; tables of
byte pairs halve the look-ups when the network is applied.

The sample holds at most ``per_label`` documents per label and ``per_doc``
windows of each (documented bounds; rows are chosen by a hash of doc_id), of
the ``max_labels`` most frequent labels. Nothing else is bounded.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
equal texts get equal answers; without labelled rows every text is ``und``; an
empty table gives no rows; other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B

WINDOW = 256
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS) - 1
UNKNOWN = "und"
LETTERS = np.zeros(256, np.float32)
LETTERS[97:123] = 1
LETTERS[0xC3:] = 1


def remainder(column: str, n: int) -> Column:
    """crc32 of a column as text, modulo n."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def windows(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all windows with the REACH bytes behind them, text of each).
    Every text has one window at least; bytes beyond a text are 0."""
    size = np.diff(offs)
    count = np.maximum(1, -(-size // WINDOW))
    text = np.repeat(np.arange(len(size)), count)
    start = offs[text] + (np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW
    at = start[:, None] + np.arange(WINDOW + REACH)
    ok = at < offs[text + 1][:, None]
    return np.where(ok, buf[np.minimum(at, len(buf) - 1)], 0).astype(np.uint8), text


class ByteCNN:
    """weights[w]: (w, 256, filters); out: (filters * len(WIDTHS), labels)."""

    def __init__(self, labels: list[str], filters: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        self.labels = labels
        self.weights = [(r.normal(size=(w, 256, filters)) * 0.3).astype(np.float32) for w in WIDTHS]
        self.bias = np.zeros(filters * len(WIDTHS), np.float32)
        self.out = (r.normal(size=(filters * len(WIDTHS), len(labels))) * 0.1).astype(np.float32)
        self.out_bias = np.zeros(len(labels), np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [*self.weights, self.bias, self.out, self.out_bias]

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        n, pooled, best = len(x), [], []
        for w in self.weights:
            z = sum(w[j][x[:, j:j + WINDOW]] for j in range(len(w)))
            best.append(z.argmax(1))
            pooled.append(np.take_along_axis(z, best[-1][:, None, :], 1)[:, 0, :])
        z = np.concatenate(pooled, 1) + self.bias
        a = np.maximum(z, 0)
        logits = a @ self.out + self.out_bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        dz = (p @ self.out.T) * (z > 0)
        grads = []
        for k, w in enumerate(self.weights):
            f = w.shape[2]
            d, g = dz[:, k * f:(k + 1) * f], np.zeros_like(w)
            for j in range(len(w)):  # only the winning positions learn
                np.add.at(g[j], (np.take_along_axis(x, best[k] + j, 1), np.arange(f)[None, :]), d)
            grads.append(g)
        return [*grads, dz.sum(0), a.T @ p, p.sum(0)]

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 11) -> ByteCNN:
        r, params, step = np.random.default_rng(seed), self.parameters(), 0
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for a in range(0, len(x), batch):
                at, step = order[a:a + batch], step + 1
                lr = rate * (1 - epoch / epochs)
                for p, g, mi, vi in zip(params, self._gradients(x[at], y[at]), m, v):
                    mi += 0.1 * (g - mi)
                    vi += 0.01 * (g * g - vi)
                    p -= lr * (mi / (1 - 0.9 ** step)) / (np.sqrt(vi / (1 - 0.99 ** step)) + 1e-7)
        return self

    def tables(self) -> list[list[tuple[int, int, np.ndarray]]]:
        """For each width: (offset, bytes covered, rows by byte or byte pair)."""
        out = []
        for w in self.weights:
            one: list = []
            for j in range(0, len(w) - 1, 2):  # the low byte of a pair comes first
                one.append((j, 2, (w[j + 1][:, None, :] + w[j][None, :, :]).reshape(65536, -1)))
            if len(w) % 2:
                one.append((len(w) - 1, 1, w[-1]))
            out.append(one)
        return out

    def logits(self, x: np.ndarray, tables: list) -> np.ndarray:
        pair = x[:, :-1].astype(np.uint16) | (x[:, 1:].astype(np.uint16) << 8)
        pooled = []
        for one in tables:
            z = None
            for j, covered, rows in one:
                got = rows[(pair if covered == 2 else x)[:, j:j + WINDOW]]
                z = got if z is None else np.add(z, got, out=z)
            pooled.append(z.max(1))
        return np.maximum(np.concatenate(pooled, 1) + self.bias, 0) @ self.out + self.out_bias


def sample_windows(docs: DataFrame, label: str, per_label: int, per_doc: int, max_labels: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(labels, windows, label numbers) of a bounded sample."""
    from pyspark.sql import Window

    counts = {r[0]: r[1] for r in docs.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_labels).collect()}
    labels = sorted(counts)
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col(label) == name, min(1_000_000, 2_000_000 * per_label // n)).otherwise(share)
    h = F.xxhash64("doc_id")
    few = docs.filter(F.pmod(h, F.lit(1_000_000)) < share)
    few = few.withColumn("__n", F.row_number().over(Window.partitionBy(label).orderBy(h, "doc_id", "text"))).filter(F.col("__n") <= per_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in B.slices(whole):
                x, text = windows(*B.text_buffer(b.column("text"), lower=True))
                cut = np.searchsorted(text, np.arange(b.num_rows + 1))
                pick = np.concatenate([np.unique(np.linspace(lo, hi - 1, per_doc).astype(int)) for lo, hi in zip(cut[:-1], cut[1:])])
                pick = pick[LETTERS[x[pick]].sum(1) >= 20]
                yield pa.RecordBatch.from_arrays([b.column("label").take(pa.array(text[pick])), pa.array([r.tobytes() for r in x[pick]], pa.binary())], ["label", "bytes"])

    got = few.select(F.col(label).alias("label"), "text").mapInArrow(run, "label string, bytes binary").toArrow()
    y = np.array([labels.index(v) for v in got.column("label").to_pylist()], np.int64)
    x = np.frombuffer(b"".join(got.column("bytes").to_pylist()), np.uint8).reshape(len(y), WINDOW + REACH)
    order = np.lexsort((*x.T[:8], y)) if len(y) else np.zeros(0, int)  # the order of arrival doesn't matter
    return labels, x[order], y[order]


def learn(docs: DataFrame, label: str = "lang", per_label: int = 500, per_doc: int = 3, max_labels: int = 256) -> ByteCNN:
    """Fit on the rows with text and label."""
    B.prepare(docs.sparkSession)
    rows = docs.filter(F.col(label).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(label).cast("string").alias(label))
    labels, x, y = sample_windows(rows, label, per_label, per_doc, max_labels)
    model = ByteCNN(labels)
    return model.fit(x, y) if len(y) else ByteCNN([UNKNOWN])


def identify(docs: DataFrame, model: ByteCNN) -> DataFrame:
    """docs with lang_pred and score."""
    B.prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        tables, names = net.tables(), np.array(net.labels, object)
        for whole in batches:
            for b in B.slices(whole, most=1 << 20):
                buf, offs = B.text_buffer(b.column("text"), lower=True)
                x, text = windows(buf, offs)
                logits = np.concatenate([net.logits(x[a:a + 64], tables) for a in range(0, len(x), 64)])
                weight = LETTERS[x[:, :WINDOW]].sum(1) + 1e-3
                first = np.searchsorted(text, np.arange(b.num_rows))
                mean = np.add.reduceat(logits * weight[:, None], first, 0) / np.add.reduceat(weight, first)[:, None]
                p = np.exp(mean - mean.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                letter = b.column("__letter").to_numpy(zero_copy_only=False)
                known = letter & (names[p.argmax(1)] != UNKNOWN)
                cols = [b.column(n) for n in b.schema.names if n != "__letter"]
                names_out = [n for n in b.schema.names if n != "__letter"]
                yield pa.RecordBatch.from_arrays(
                    [*cols, pa.array(np.where(known, names[p.argmax(1)], UNKNOWN), pa.string()), pa.array(np.where(known, p.max(1), 0.0), pa.float64())],
                    [*names_out, "lang_pred", "score"])

    rows = docs.withColumn("__letter", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")


def keep_identified(spark, docs: DataFrame, sf_dir: str, least: float = 0.4) -> DataFrame:
    """Pipeline stage: documents without a letter, or whose best language
    scores below ``least``, go."""
    model = learn(docs.select("doc_id", "text", "lang").filter(remainder("doc_id", 5) != 0))
    names = {"lang_pred": "__lang_pred", "score": "__score"}
    clash = [c for c in docs.columns if c in names]
    named = docs.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    kept = identify(named, model).withColumnsRenamed(names).filter((F.col("__lang_pred") != UNKNOWN) & (F.col("__score") >= least))
    return kept.drop("__lang_pred", "__score").withColumnsRenamed({f"__own_{c}": c for c in clash})


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``; learnt where crc32(doc_id) mod 5 is not 0."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = learn(docs.select("doc_id", "text", "lang").filter(remainder("doc_id", 5) != 0))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")

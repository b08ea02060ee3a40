"""Token counts of a unigram vocabulary by dynamic programming on a trie.

A text's pre-tokens are its words (``[^\\x20\\x09-\\x0D]+``), each with the one
space before it if there is one; every other white byte is a pre-token of its
own. The distinct pre-tokens of a task's batch form a trie, built level by
level on whole arrays; each node's best segmentation score is computed once,
from its ancestors' scores and the vocabulary pieces that end at it, so shared
prefixes share their work. Nodes where a pre-token ends store its token count.

The vocabulary is a file of ranked byte pieces, its path a parameter (read on
the driver, its size doesn't depend on the data). The log probability of the
piece of rank r is taken as that of a Zipf law, -log(r + 1) less its norm.
Every single byte must be a piece, so every text can be segmented. Of equal
scores the segmentation whose last piece is shortest is taken, at every node.

Everything happens in the task that reads the text: no shuffle, and a task
keeps at most KEPT counts. Defined cases: null and empty texts have 0 tokens;
repeated texts count alike; a pre-token of any length is handled; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B

U = np.uint64
KEPT = 2_000_000


class Vocabulary:
    """Reversed-free piece trie as a transition table over (node, byte)."""

    def __init__(self, ranked: list[bytes]):
        norm = np.log((1 / np.arange(1, len(ranked) + 1)).sum())
        scores = {p: -np.log(r + 1) - norm for r, p in reversed(list(enumerate(ranked)))}
        missing = [b for b in range(256) if bytes([b]) not in scores]
        if missing:
            raise ValueError(f"bytes without a piece: {missing}")
        nodes: dict[bytes, int] = {b"": 0}
        keys, score = [], [-np.inf]
        for p in sorted(scores):
            for n in range(1, len(p) + 1):
                if p[:n] not in nodes:
                    nodes[p[:n]] = len(nodes)
                    keys.append(nodes[p[:n - 1]] << 8 | p[n - 1])
                    score.append(scores.get(p[:n], -np.inf))
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.to = np.array(keys, np.int64)[order], (order + 1).astype(np.int64)
        self.score = np.array(score)
        self.longest = max(map(len, scores))

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next nodes, -1 where no piece goes on."""
        key = node << 8 | byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)


def trie_counts(buf: np.ndarray, start: np.ndarray, size: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, best score) of each byte string buf[start:start+size]."""
    n = len(start)
    tokens, best = np.zeros(n, np.int64), np.zeros(n)
    here = np.zeros(n, np.int64)  # trie node of each string at this depth
    # by depth: parent, byte, score and count of the nodes (a sliding window of levels)
    score, count = [np.zeros(1)], [np.zeros(1, np.int64)]
    # open pieces: (trie node at the present depth, depth where begun, node there, vocabulary node)
    open_node = open_from = open_at = open_voc = np.zeros(0, np.int64)
    alive, depth = np.flatnonzero(size > 0), 0
    while len(alive):
        # nodes of the next level: distinct (node, byte)
        key, back = np.unique(here[alive] << 8 | buf[start[alive] + depth], return_inverse=True)
        parent, byte = key >> 8, key & 255
        # pieces go on along every child; one more begins at each parent
        m = len(score[-1])
        open_node = np.concatenate([open_node, np.arange(m)])
        open_from = np.concatenate([open_from, np.full(m, depth)])
        open_at = np.concatenate([open_at, np.arange(m)])
        open_voc = np.concatenate([open_voc, np.zeros(m, np.int64)])
        order = np.argsort(open_node, kind="stable")
        lo, hi = np.searchsorted(open_node[order], parent, "left"), np.searchsorted(open_node[order], parent, "right")
        pick, child = order[B.expand(lo, hi - lo)], np.repeat(np.arange(len(key)), hi - lo)
        voc = vocabulary.step(open_voc[pick], byte[child])
        on = voc >= 0
        open_node, open_from, open_at, open_voc = child[on], open_from[pick[on]], open_at[pick[on]], voc[on]
        # best ending piece at each node
        new_score, new_count = np.full(len(key), -np.inf), np.zeros(len(key), np.int64)
        ends = vocabulary.score[open_voc]
        for begun in range(depth, max(-1, depth - vocabulary.longest), -1):  # short pieces first
            at = np.flatnonzero((open_from == begun) & (ends > -np.inf))
            if len(at):
                node, s = open_node[at], score[begun][open_at[at]] + ends[at]
                better = s > new_score[node]
                node, at = node[better], at[better]
                new_score[node], new_count[node] = s[better], count[begun][open_at[at]] + 1
        score.append(new_score)
        count.append(new_count)
        if len(score) > vocabulary.longest + 1:
            score[-vocabulary.longest - 2] = count[-vocabulary.longest - 2] = None  # out of reach
        here[alive] = back
        depth += 1
        done = alive[size[alive] == depth]
        tokens[done], best[done] = new_count[here[done]], new_score[here[done]]
        alive = alive[size[alive] > depth]
        if not len(alive):
            break
        used = np.zeros(len(key), bool)  # nodes that no longer string passes need no piece
        used[here[alive]] = True
        on = used[open_node]
        open_node, open_from, open_at, open_voc = open_node[on], open_from[on], open_at[on], open_voc[on]
    return tokens, best


def pre_tokens(buf: np.ndarray, offs: np.ndarray):
    """(starts, sizes, pre-token offsets by text, white bytes left by text)."""
    start, size, word_offs = B.words(buf, offs)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(word_offs))
    led = (start > offs[text]) & (buf[np.maximum(start - 1, 0)] == 32)
    white = np.diff(offs) - np.bincount(text, size + led, len(offs) - 1).astype(np.int64)
    return start - led, size + led, word_offs, white


def ranked_pieces(path: str) -> list[bytes]:
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    return [base64.b64decode(a) for a, _ in sorted(rows, key=lambda r: int(r[1]))]


def token_counts(docs: DataFrame, vocabulary_path: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, n_pre_tokens, n_tokens, log_prob of every text."""
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    spark = docs.sparkSession
    B.prepare(spark)
    sent = spark.sparkContext.broadcast(Vocabulary(ranked_pieces(vocabulary_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        keys, tokens, best = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0)
        space = np.frombuffer(bytes([9, 10, 11, 12, 13, 32]) + bytes(B.PAD), np.uint8)
        white_best = trie_counts(space, np.arange(6), np.ones(6, np.int64), vocabulary)[1]
        worth = np.zeros(256)
        worth[[9, 10, 11, 12, 13, 32]] = white_best
        for whole in batches:
            for b in B.slices(whole, most=2 << 20):
                buf, offs = B.text_buffer(b.column("text"))
                start, size, pre_offs, white = pre_tokens(buf, offs)
                key, at, back = np.unique(B.hash_spans(buf, start, size), return_index=True, return_inverse=True)
                if len(keys) > KEPT:
                    keys, tokens, best = keys[:0], tokens[:0], best[:0]
                known = keys[np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))] == key if len(keys) else np.zeros(len(key), bool)
                new = np.flatnonzero(~known)
                t, s = trie_counts(buf, start[at[new]], size[at[new]], vocabulary)
                keys, tokens, best = np.concatenate([keys, key[new]]), np.concatenate([tokens, t]), np.concatenate([best, s])
                order = np.argsort(keys, kind="stable")
                keys, tokens, best = keys[order], tokens[order], best[order]
                found = np.searchsorted(keys, key)[back]
                text, n = np.repeat(np.arange(b.num_rows), np.diff(pre_offs)), b.num_rows
                # white bytes outside pre-tokens
                lone = B.WHITE[buf[:offs[-1]]]
                lone[start[(buf[start] == 32)]] = False
                lone = np.flatnonzero(lone)
                of = np.searchsorted(offs, lone, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in keep), pa.array(np.diff(pre_offs) + white),
                     pa.array(np.bincount(text, tokens[found], n).astype(np.int64) + white),
                     # bincount of nothing counts in whole numbers, weights or not
                     pa.array((np.bincount(text, best[found], n) + np.bincount(of, worth[buf[lone]], n)).astype(float))],
                    [*keep, "n_pre_tokens", "n_tokens", "log_prob"])

    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.select(*keep, "text").mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_pre_tokens long, n_tokens long, log_prob double")


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Harmonic packing of tokenised documents into fixed-length sequences.

Documents become ids of a byte-level BPE vocabulary (words of the usual
pattern are found on whole byte buffers and each distinct word is encoded
once), then one end id. A document is cut into whole sequences and a rest; the
rest is cut greedily into pieces of capacity / j ids (j = 2, 3, ...), so that
pieces lie at the upper end of their reciprocal class j = capacity // length.
Each task fills the bins of class j with exactly j pieces, independent of
other tasks and classes, so padding is below one piece in j + 1 and mostly a
few ids. What a task's classes hold at its end is laid out in a row, cut into
whole sequences and, last, sequences of power-of-two lengths, which need no
padding.

A task holds at most one open bin per class. Sequence ids carry the task's
partition number; the input partitions must be stable (a scan), so that a task
that runs again gives the same rows.

Defined cases: null and empty texts are the end id alone; a text of any length
is cut; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B

U = np.uint64
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
SPECIAL = b"<|endoftext|>"
LEAST_CUT = 32
_CACHE: dict = {}
KEPT_WORDS = 400_000  # of one process; words beyond are encoded again


def _classes() -> np.ndarray:
    """Class of every code point in the vocabulary's word pattern."""
    if "classes" not in _CACHE:
        table = np.zeros(0x110000, np.uint8)
        chars = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, chars):
                a, b = ord(chars[m.start()]), ord(chars[m.end() - 1])
                table[a:b + 1] = kind
        table[0xD800:0xE000] = OTHER
        _CACHE["classes"] = table
    return _CACHE["classes"]


def pre_tokens(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions where words begin, by the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?[^ L N white]+|white+(?!\\S)|white+"""
    n = int(offs[-1])
    chars = np.flatnonzero((buf[:n] & 0xC0) != 0x80)
    if not len(chars):
        return chars
    lead = buf[chars]
    code = lead.astype(np.int32)
    for least, bits, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        at = np.flatnonzero((lead >= least) & (lead < (0xE0, 0xF0, 0x100)[more - 1]))
        if len(at):
            c = (lead[at] & bits).astype(np.int32)
            for j in range(1, more + 1):
                c = c << 6 | (buf[chars[at] + j] & 0x3F)
            code[at] = c
    kind = _classes()[code]
    m = len(chars)
    first = np.zeros(m + 1, bool)
    first[np.searchsorted(chars, offs)] = True  # of a text; m stands for the end
    run = np.ones(m + 1, bool)
    run[1:m] = kind[1:] != kind[:-1]
    run |= first
    begin = run.copy()
    last = (kind == SPACE) & run[1:] & ~first[1:]  # last white space before a word
    begin[:m] |= last
    attached = np.flatnonzero(last & (lead == 32))
    begin[attached + 1] = False
    # contractions: an apostrophe that begins a word, before letters
    q = np.flatnonzero((lead == 39) & begin[:m] & run[:m])
    q = q[q + 1 < m]
    q = q[(kind[q + 1] == LETTER) & ~first[q + 1]]
    if len(q):
        one = code[q + 1]
        two = np.where((q + 2 < m) & ~run[np.minimum(q + 2, m)], code[np.minimum(q + 2, m - 1)], 0)
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        for pair in ("re", "ve", "ll"):
            size = np.where((one == ord(pair[0])) & (two == ord(pair[1])), 2, size)
        q, size = q[size > 0], size[size > 0]
        begin[q + 1] = False
        begin[q + 1 + size] = True
    return chars[begin[:m]]


def piece_bytes(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """A byte-level vocabulary's pieces as bytes. Its alphabet writes
    printable bytes as they are, the others as the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(alphabet[c] for c in piece): i for piece, i in vocabulary.items() if all(c in alphabet for c in piece)}


class Encoder:
    """Ids of texts, each distinct word encoded once per process as long as
    KEPT_WORDS last. Where ids rise with the vocabulary's merges, a word's
    merges by rank are its merges by id, and it is encoded from its bytes;
    else the tokenizer encodes it."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        model = json.loads(vocabulary)["model"]
        merged = [model["vocab"].get(("".join(m) if isinstance(m, list) else m.replace(" ", "", 1)), -1) for m in model.get("merges", [])]
        self.one = None
        if merged and merged[0] >= 0 and all(a < b for a, b in zip(merged, merged[1:])):
            import tiktoken

            special = {t["content"] for t in json.loads(vocabulary).get("added_tokens", [])}
            ranks = piece_bytes({k: v for k, v in model["vocab"].items() if k not in special})
            self.one = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.clear()

    def clear(self) -> None:
        self.keys, self.start, self.size = np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word)."""
        if self.one:
            ids = [self.one(w) for w in words]
        else:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(count.sum())), count

    def _learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        parts = [self._words(words[i:i + 4096]) for i in range(0, len(words), 4096)]  # a few at a time: lists are large
        flat, size = (np.concatenate(x) for x in zip(*parts))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + len(flat)] = flat
        start = self.used + np.cumsum(size) - size
        self.used += len(flat)
        at = np.searchsorted(self.keys, keys)  # both sorted
        self.keys, self.start, self.size = np.insert(self.keys, at, keys), np.insert(self.start, at, start), np.insert(self.size, at, size)

    def encode(self, column) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text)."""
        buf, offs = B.text_buffer(column)
        begin = pre_tokens(buf, offs)
        n = int(offs[-1])
        size = np.diff(np.concatenate([begin, [n]]))
        key, at, back = np.unique(B.hash_spans(buf, begin, size), return_index=True, return_inverse=True)
        if len(self.keys) > KEPT_WORDS:
            self.clear()
        new = np.flatnonzero(~self._has(key))
        if len(new):
            raw = buf.tobytes()
            first = begin[at[new]]
            self._learn(key[new], [raw[a:b] for a, b in zip(first.tolist(), (first + size[at[new]]).tolist())])
        found = np.searchsorted(self.keys, key)
        count = self.size[found][back]
        ids = self.pool[B.expand(self.start[found][back], count)]
        per_word = np.concatenate([[0], np.cumsum(count)])
        text_offs = per_word[np.searchsorted(begin, offs)]
        if SPECIAL in buf[:n].tobytes():  # the tokenizer's own way with its special string
            parts = [np.array(self.tokenizer.encode(t or "", add_special_tokens=False).ids, np.uint32) if t and SPECIAL.decode() in t else ids[a:b]
                     for t, a, b in zip(column.to_pylist(), text_offs[:-1], text_offs[1:])]
            ids, text_offs = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, text_offs

    def _has(self, key: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(key), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key


def cuts(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n ids."""
    out, rest = [capacity] * (n // capacity), n % capacity
    while rest >= LEAST_CUT:
        out.append(capacity // -(-capacity // rest))
        rest -= out[-1]
    return out + [rest] * (rest > 0)


class Packer:
    """Open bins of one task; sequences come out as lists of rows."""

    def __init__(self, capacity: int, worker: int):
        self.capacity, self.worker, self.made = capacity, worker, 0
        self.open: dict[int, list] = {}
        self.rows: list[list] = [[] for _ in range(6)]

    def _emit(self, pieces: list) -> None:
        at, name = 0, (self.worker << 33) + self.made
        self.made += 1
        for doc, start, ids, total in pieces:
            for to, v in zip(self.rows, (doc, start, ids.tobytes(), total, name, at)):
                to.append(v)
            at += len(ids)

    def add(self, doc, ids: np.ndarray) -> None:
        at = 0
        for n in cuts(len(ids), self.capacity):
            piece = (doc, at, ids[at:at + n], len(ids))
            at += n
            kind = self.capacity // n
            held = self.open.setdefault(kind, [])
            held.append(piece if kind == 1 else (*piece[:2], piece[2].copy(), piece[3]))
            if len(held) == kind:
                self._emit(held)
                self.open[kind] = []

    def close(self) -> None:
        left = [p for kind in sorted(self.open) for p in self.open[kind]]
        total = sum(len(p[2]) for p in left)
        while total:
            room = self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
            total -= room
            sequence = []
            while room:
                doc, start, ids, whole = left.pop(0)
                if len(ids) > room:
                    left.insert(0, (doc, start + room, ids[room:], whole))
                    ids = ids[:room]
                sequence.append((doc, start, ids, whole))
                room -= len(ids)
            self._emit(sequence)

    def take(self) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        out = pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(self.rows, types)], ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"])
        self.rows = [[] for _ in range(6)]
        return out


def pack(docs: DataFrame, vocabulary_path: str | None = None, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces (doc_id, start, ids, doc_tokens, sequence_id, offset); ids are
    little-endian unsigned 32-bit numbers. ``vocabulary_path``: a byte-level
    BPE file of the tokenizers library, read on the driver (its size doesn't
    depend on the data)."""
    if vocabulary_path is None:
        import public_tokenizers

        vocabulary_path = public_tokenizers.path("byte_bpe_50k.json")
    spark = docs.sparkSession
    B.prepare(spark)
    with open(vocabulary_path, encoding="utf-8") as f:
        sent = spark.sparkContext.broadcast((f.read(), _classes()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = ("encoder", vocabulary_path)
        if key not in _CACHE:
            vocabulary, _CACHE["classes"] = sent.value
            _CACHE[key] = Encoder(vocabulary)
        packer = Packer(capacity, TaskContext.get().partitionId())
        for whole in batches:
            for b in B.slices(whole, most=2 << 20):
                ids, offs = _CACHE[key].encode(b.column("text"))
                ids = np.insert(ids, offs[1:], end_id).astype("<u4")
                offs = offs + np.arange(len(offs))
                for doc, x, y in zip(b.column("doc_id").to_pylist(), offs[:-1], offs[1:]):
                    packer.add(doc, ids[x:y])
                yield packer.take()
        packer.close()
        yield packer.take()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, start long, ids binary, doc_tokens long, sequence_id long, offset long")


def packed_digest(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
                             "doc_tokens", "sequence_id", "offset")


def pack_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last pipeline stage: packed pieces."""
    return packed_digest(docs)


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return packed_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Numpy helpers on Arrow text columns, used inside tasks.

Texts of a batch are one byte buffer plus offsets; words and their 64-bit
hashes come from whole-buffer operations. Hashes are 64 bits wide: with V
distinct keys the chance that any two clash is below V*V / 2**65.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=U)
LONG_WORD = 64
PAD = 16


BATCH_BYTES = 4 << 20


def prepare(spark) -> None:
    """Ship the package, and let Arrow batches hold a few MB (texts are long;
    the limit by rows alone would make batches of any size)."""
    from busframes.session import ship_package

    ship_package(spark)
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    text = spark.conf.get(name, "64m")
    if not text.isdigit() or int(text) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system: a worker lives on between tasks,
    and what it holds counts as its executor's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (on a copy)."""
    h = h ^ (h >> U(32))
    h *= U(0x9E3779B97F4A7C15)
    h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    return h


def text_buffer(column, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with PAD zeros behind, offsets from 0); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(PAD, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    buf = np.zeros(offs[-1] - offs[0] + PAD, np.uint8)
    if offs[-1] > offs[0]:
        part = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]]
        buf[:len(part)] = LOWER[part] if lower else part
    return buf, offs - offs[0]


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most ``most`` bytes of text each (one
    row at least), so that temporary arrays stay small."""
    col = batch.column(column)
    if not batch.num_rows:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    offs = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
    release()


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, word offsets by text) of words [^\\x20\\x09-\\x0D]+."""
    n = int(offs[-1])
    inside = ~WHITE[buf[:n]]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    filled = offs[:-1] < offs[1:]
    a, b = offs[:-1][filled], offs[1:][filled] - 1
    first[a], last[b] = inside[a], inside[b]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, offs)


def hash_spans(buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans. ``buf`` has PAD bytes behind."""
    eight = np.ndarray((len(buf) - 7,), "<u8", buf, 0, (1,))
    h = mix(lengths.astype(U) + U(0x5851F42D4C957F2D))
    short = lengths <= LONG_WORD
    at = np.arange(len(starts)) if short.all() else np.flatnonzero(short)
    done = 0
    while len(at):
        left = lengths[at] - done
        h[at] = mix(h[at] ^ (eight[starts[at] + done] & _MASKS[np.minimum(left, 8)]))
        done += 8
        at = at[left > 8]
    for i in np.flatnonzero(~short):
        h[i] = xxhash.xxh3_64_intdigest(buf[starts[i]:starts[i] + lengths[i]].tobytes(), 7)
    return h


def shingles(h: np.ndarray, word_offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets by text) of all k-word shingles in text order; a text
    of 1 to k-1 words is one shingle, a text without words has none."""
    n = np.diff(word_offs)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    offs = np.concatenate([[0], np.cumsum(count)])
    if not len(h):
        return np.zeros(0, U), offs
    at = np.repeat(word_offs[:-1] - offs[:-1], count) + np.arange(offs[-1])
    out = np.zeros(len(at), U)
    reach = np.repeat(np.minimum(n, k), count)
    for j in range(k):
        if j == 0:
            out = mix(h[at] + reach.astype(U))
        else:
            on = reach > j
            if on.all():
                out = mix(out + h[at + j])
            else:
                out[on] = mix(out[on] + h[at[on] + j])
    return out, offs


def hashed_words(column) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words, word offsets by text)."""
    buf, offs = text_buffer(column, lower=True)
    starts, lengths, word_offs = words(buf, offs)
    return hash_spans(buf, starts, lengths), word_offs


def runs(values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def expand(lo: np.ndarray, count: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (count[0] of them), lo[1], ..."""
    count = np.asarray(count, np.int64)
    ends = np.cumsum(count)
    return np.repeat(lo - (ends - count), count) + np.arange(ends[-1] if len(ends) else 0)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by that key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = runs(keys)
        for a, b in zip(cuts[:-1], cuts[1:]):
            if held and held[-1].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)

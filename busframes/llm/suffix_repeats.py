"""Repeated byte strings by common-prefix interval trees.

Every byte covered by a ``length``-byte string that also starts elsewhere (in
any text, itself included) is found, exactly up to 64-bit hash clashes.

1. *Anchors.* The anchor of a start p is the position of the least hash of a
   GRAM-byte string inside p's string. Equal strings have equal anchors at
   equal offsets. Consecutive starts with one anchor are its territory; the
   bytes that their strings span are its region. There is one anchor in
   (length - GRAM + 2) / 2 bytes, so nothing of the size of all suffixes is
   ever shuffled.
2. *Equal regions* (anchor hash, region hash) are repeated as a whole. Tasks
   collapse them before the shuffle; the rest meets by anchor hash, in sorted
   streams. An anchor hash with one region only repeats nothing more.
3. *Different regions under one anchor* (the edges of repeats) go, one
   occurrence each, to their anchor's task, which builds the enhanced suffix
   array of their starts and scans its common-prefix intervals with a stack.
   An interval whose occurrences have different bytes on their left (or begin
   their territory) is a maximal repeat group; it covers every occurrence, not
   just neighbours. Other intervals are implied by the group one byte earlier.
4. An anchor with more regions than fit ``group_bytes`` is refined: each start
   becomes a territory of its own, keyed by its whole string, and step 2 is
   the exact answer.

Defined cases: null text is empty; texts shorter than ``length`` repeat
nothing; rows that repeat both doc_id and text are two texts; very long texts
are read in pieces (a territory cut in two stays exact); an empty table gives
no rows; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.llm import bytesops as B
from busframes.session import checkpoint_base

U = np.uint64
GRAM = 40
PIECE = 1 << 20
TAILS = 4 << 20  # bytes of the suffixes that are sorted at a time
MULT = 0x9E3779B97F4A7C15 | 1
_BYTE = B.mix(np.arange(1, 257).astype(U))
SPANS = "key long, r long, rid long, s long, e long, kind int"
SINGLE, MANY, COVER = 0, 1, 2


def rolling(buf: np.ndarray, *widths: int) -> list[np.ndarray]:
    """64-bit hashes of buf[i:i+width] for every i, for each width."""
    out: list = [None] * len(widths)
    done = [0] * len(widths)
    block, size = _BYTE[buf], 1
    while True:
        power = U(pow(MULT, size, 1 << 64))
        for i, w in enumerate(widths):
            if w & size:
                n = len(buf) - done[i] - size + 1
                if n <= 0:
                    out[i] = np.zeros(0, U)
                else:
                    out[i] = block[:n].copy() if out[i] is None else out[i][:n] * power + block[done[i]:done[i] + n]
                done[i] += size
        if size * 2 > max(widths) or len(block) <= size:
            return [B.mix(x) if d == w else np.zeros(0, U) for x, d, w in zip(out, done, widths)]
        block = block[:-size] * power + block[size:]
        size *= 2


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        a = np.minimum(a[:-size], a[size:])
        size *= 2
    return np.minimum(a[:len(a) - (width - size)], a[width - size:]) if width > size else a


def territories(buf: np.ndarray, offs: np.ndarray, length: int):
    """(text, anchor hash, region hash, first start, end of region) of every
    territory; positions count from each text's begin."""
    found = [[] for _ in range(5)]
    n = int(offs[-1])
    at = 0
    while at + length <= n:
        piece = buf[at:min(n, at + PIECE + length - 1)]
        gram, whole = rolling(piece, GRAM, length)
        packed = (gram & U(~0xFFFFFF & (2**64 - 1))) | np.arange(len(gram)).astype(U)
        anchor = (_least(packed, length - GRAM + 1) & U(0xFFFFFF)).astype(np.int64)
        starts = np.arange(at, at + len(whole))
        text = np.searchsorted(offs, starts, "right") - 1
        ok = np.flatnonzero(starts + length <= offs[text + 1])
        if len(ok):
            cut = np.flatnonzero((np.diff(anchor[ok]) != 0) | (np.diff(text[ok]) != 0) | (np.diff(ok) != 1)) + 1
            a, b = ok[np.concatenate([[0], cut])], ok[np.concatenate([cut - 1, [len(ok) - 1]])]
            x = anchor[a]
            region = B.mix(B.mix(whole[a] + ((b - a) * 1024 + (x - a)).astype(U)) ^ whole[b])
            base = offs[text[a]] - at
            for to, v in zip(found, (text[a], gram[x], region, a - base, b - base + length)):
                to.append(v)
        at += PIECE
    if not found[0]:
        return [np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    return [np.concatenate(x) for x in found]


def _rows(key, r, rid, s, e, kind) -> Iterator[pa.RecordBatch]:
    names = ["key", "r", "rid", "s", "e", "kind"]
    for a in range(0, len(key), 100_000):
        c = slice(a, a + 100_000)
        yield pa.RecordBatch.from_arrays([pa.array(key[c].view(np.int64)), pa.array(r[c].view(np.int64)), pa.array(rid[c]), pa.array(s[c]), pa.array(e[c]), pa.array(kind[c].astype(np.int32))], names)


def _collapse(parts: list) -> Iterator[pa.RecordBatch]:
    """Regions met twice in this task are covered; one of each goes on."""
    key, r, rid, s, e = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((r, key))
    key, r, rid, s, e = (x[order] for x in (key, r, rid, s, e))
    cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]) | (r[1:] != r[:-1])) + 1])
    count = np.diff(np.concatenate([cuts, [len(key)]]))
    yield from _rows(key[cuts], r[cuts], rid[cuts], s[cuts], e[cuts], np.where(count > 1, MANY, SINGLE))
    on = np.repeat(count > 1, count)
    yield from _rows(rid[on], np.zeros(int(on.sum()), np.int64), rid[on], s[on], e[on], np.full(int(on.sum()), COVER))


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, r): COVER rows of regions met twice, and one
    row of each region of a key with several. One row is carried over."""
    carry, told = None, False
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        done = cols[5] == COVER
        yield from _rows(*(x[done] for x in cols))
        cols = [x[~done] for x in cols]
        if not len(cols[0]):
            continue
        if carry is not None:
            cols = [np.concatenate([[c], x]) for c, x in zip(carry, cols)]
        key, r, rid, s, e, kind = cols
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.flatnonzero(new_key | np.concatenate([[True], r[1:] != r[:-1]]))
        count = np.diff(np.concatenate([first, [len(key)]]))
        on = np.repeat(count > 1, count)
        yield from _rows(rid[on], np.zeros(int(on.sum()), np.int64), rid[on], s[on], e[on], np.full(int(on.sum()), COVER))
        many = np.maximum(np.maximum.reduceat(kind, first), np.where(count > 1, MANY, SINGLE))
        which = np.cumsum(new_key)[first] - 1
        several = np.bincount(which)[which] > 1
        same_key = carry is not None
        if same_key and told:
            several |= which == 0
        out = several.copy()
        if same_key and told:
            out[0] = False
        f = first[out]
        yield from _rows(key[f], r[f], rid[f], s[f], e[f], many[out])
        carry, told = [x[-1] for x in cols], bool(several[-1])
        carry[5] = many[-1]


def _spread(found: DataFrame) -> DataFrame:
    parts = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "key").sortWithinPartitions("key", "r").mapInArrow(_meet, SPANS)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64("doc_id", "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text"))


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        held, size = [], 0
        for whole in batches:
            for b in B.slices(whole, most=PIECE):
                text, key, r, s, e = territories(*B.text_buffer(b.column("text")), length)
                held.append((key, r, b.column("rid").to_numpy(zero_copy_only=False)[text], s, e))
                size += len(key)
                if size >= 1_000_000:
                    yield from _collapse(held)
                    held, size = [], 0
        if size:
            yield from _collapse(held)

    return _texts(docs).mapInArrow(run, SPANS)


def _refined(rows: DataFrame, length: int) -> DataFrame:
    """Each start of the given regions as a territory of its own."""
    def run(batches):
        for whole in batches:
            for b in B.slices(whole, most=PIECE):
                held = []
                for rid, text, spans in zip(b.column("rid").to_pylist(), b.column("text"), b.column("spans").to_pylist()):
                    data = np.frombuffer(text.as_buffer(), np.uint8)
                    for x in spans:
                        h = rolling(data[x["s"]:x["e"]], length)[0]
                        s = np.arange(x["s"], x["s"] + len(h))
                        held.append((h, h, np.full(len(h), rid, np.int64), s, s + length))
                        if x["kind"] == MANY:  # stands for several texts: its starts meet themselves
                            held.append(held[-1])
                if held:
                    yield from _collapse(held)

    return rows.mapInArrow(run, SPANS)


def interval_cover(order_lcp: np.ndarray, left: np.ndarray, least: int, groups: list | None = None) -> np.ndarray:
    """Stack-scan of the common-prefix intervals of a suffix array.

    order_lcp[i]: common prefix of suffixes i-1 and i (0 for the first);
    left[i]: the byte before suffix i, -1 where it can't be extended. Returns
    for each suffix the length of the deepest maximal repeat group of at least
    ``least`` bytes that holds it, else 0; ``groups`` gets each group as
    (length, first, last) in suffix array order."""
    n = len(left)
    cover = np.zeros(n, np.int64)
    stack: list[list] = []  # prefix, first suffix, uniform left byte or -1, suffixes without cover
    lcp, before = order_lcp.tolist() + [0], left.tolist()

    def close(top: list, last: int) -> None:
        if top[0] >= least and top[2] == -1:
            cover[top[3]] = top[0]
            top[3] = []
            if groups is not None:
                groups.append((top[0], top[1], last))

    for i in range(1, n + 1):
        now = lcp[i] if lcp[i] >= least else 0
        first, side, free = i - 1, before[i - 1], [i - 1]
        while stack and stack[-1][0] > now:
            top = stack.pop()
            top[3] += free
            top[2] = top[2] if top[2] == side else -1
            close(top, i - 1)
            first, side, free = top[1], top[2], top[3]
        if now:
            if stack and stack[-1][0] == now:
                top = stack[-1]
                top[2] = top[2] if top[2] == side else -1
                if len(top[3]) < len(free):
                    top[3], free = free, top[3]
                top[3] += free
            else:
                stack.append([now, first, side, free])
    return cover


def suffix_cover(regions: list[bytes], length: int, groups: list | None = None):
    """(region, start, covered length) of the starts that maximal repeat
    groups cover; the starts of a region have ``length`` bytes behind them.
    Strings are hashed in slabs of regions, and the suffix array is made for
    some classes of equal strings at a time: groups never cross classes, and a
    region has at most one start in each."""
    buf = np.frombuffer(b"".join(regions), np.uint8)
    sizes = np.array([len(x) for x in regions])
    offs = np.concatenate([[0], np.cumsum(sizes)])
    count = sizes - length + 1
    first = np.concatenate([[0], np.cumsum(count)])
    h, a = np.zeros(first[-1], U), 0
    while a < len(regions):
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + PIECE, "right")) - 1)
        h[first[a]:first[b]] = rolling(buf[offs[a]:offs[b]], length)[0][B.expand(offs[a:b] - offs[a], count[a:b])]
        a = b
    classes = np.argsort(h, kind="stable")
    cuts = B.runs(h[classes])
    del h
    n = np.diff(cuts)
    some = np.flatnonzero(n > 1)  # other strings occur once
    ends = np.cumsum(n[some])
    most = max(1, TAILS // (int(sizes.max(initial=length)) - length + 1))
    found, a, before = [], 0, 0
    while a < len(some):
        b = max(a + 1, int(np.searchsorted(ends, before + most, "right")))
        mine = classes[B.expand(cuts[some[a:b]], n[some[a:b]])]
        region = np.searchsorted(first, mine, "right") - 1
        own = None if groups is None else []
        found.append(_class_cover(buf, offs, region, mine - first[region], np.repeat(np.arange(b - a), n[some[a:b]]), length, own))
        if own:
            groups.extend((size, x + before, y + before) for size, x, y in own)
        a, before = b, int(ends[b - 1])
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


def _class_cover(buf: np.ndarray, offs: np.ndarray, region: np.ndarray, inside: np.ndarray, cls: np.ndarray, length: int, groups: list | None):
    """suffix_cover for the starts of whole classes, given class by class."""
    at = offs[region] + inside
    # suffix array: equal strings are neighbours, ordered by what follows
    rest = offs[region + 1] - at - length
    width = int(rest.max())
    tail = np.zeros((len(at), width + 1), np.uint8)
    for j in range(width):
        ok = np.flatnonzero(rest > j)
        tail[ok, j] = buf[at[ok] + (length + j)]
    order = np.argsort(tail.reshape(-1).view(f"S{width + 1}"), kind="stable")
    order = order[np.argsort(cls[order], kind="stable")]
    region, at, inside, rest, tail, cls = (x[order] for x in (region, at, inside, rest, tail, cls))
    differ = tail[1:] != tail[:-1]
    same = np.where(differ.any(1), differ.argmax(1), width)
    lcp = np.concatenate([[0], np.where(cls[1:] == cls[:-1], length + np.minimum(same, np.minimum(rest[1:], rest[:-1])), 0)])
    left = np.where(inside > 0, buf[np.maximum(at - 1, 0)].astype(np.int64), -1)
    cover = interval_cover(lcp, left, length, groups)
    on = cover > 0
    return region[on], inside[on], cover[on]


def _detail(rows: DataFrame, length: int) -> DataFrame:
    """COVER rows of regions (rid, text, spans) that differ under one anchor."""
    def cut(batches):
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        for whole in batches:
            for b in B.slices(whole):
                out: list[list] = [[] for _ in types]
                for rid, text, spans in zip(b.column("rid").to_pylist(), b.column("text"), b.column("spans").to_pylist()):
                    data = text.as_buffer()
                    for x in spans:
                        for to, v in zip(out, (x["key"], rid, x["s"], x["kind"], data[x["s"]:x["e"]].to_pybytes())):
                            to.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], ["key", "rid", "s", "kind", "bytes"])

    def scan(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        region, inside, cover = suffix_cover(t.column("bytes").to_pylist(), length)
        rid, s, kind = (t.column(c).to_numpy() for c in ("rid", "s", "kind"))
        new = kind[region] == SINGLE  # the others are covered as a whole
        region, inside, cover = region[new], inside[new], cover[new]
        s = s[region] + inside
        yield from _rows(rid[region], np.zeros(len(s), np.int64), rid[region], s, s + cover, np.full(len(s), COVER))

    def run(batches):
        held, room, last = [], PIECE, None
        for b in batches:
            while b.num_rows:
                keys = b.column("key").to_numpy(zero_copy_only=False)
                if room <= 0 and keys[0] != last:
                    yield from scan(held)
                    held, room = [], PIECE
                take = max(1, room // (2 * length))
                if take < len(keys):  # whole keys
                    cut = np.flatnonzero(keys[take:] != keys[take - 1:-1])
                    take = take + int(cut[0]) if len(cut) else len(keys)
                held.append(b.slice(0, take))
                room, last, b = room - take * 2 * length, keys[min(take, len(keys)) - 1], b.slice(take)
        if held:
            yield from scan(held)

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.mapInArrow(cut, "key long, rid long, s long, kind int, bytes binary")
            .repartition(parts, "key").sortWithinPartitions("key").mapInArrow(run, SPANS))


def repeat_spans(docs: DataFrame, length: int = 200, group_bytes: int = 16 << 20) -> DataFrame:
    """(rid, s, e): byte spans, overlapping and repeated, whose union is what
    ``length``-byte strings that start twice or more cover."""
    checkpoint_base(docs.sparkSession)
    B.prepare(docs.sparkSession)
    met = _spread(_anchored(docs, length)).checkpoint()
    open_ = met.filter(F.col("kind") != COVER)
    hot = open_.groupBy("key").agg(F.sum(F.col("e") - F.col("s")).alias("w")).filter(F.col("w") > group_bytes).select("key").checkpoint()

    def with_text(rows: DataFrame) -> DataFrame:
        spans = rows.groupBy("rid").agg(F.collect_list(F.struct("key", "s", "e", "kind")).alias("spans"))
        return _texts(docs).join(spans, "rid")

    out = met.filter(F.col("kind") == COVER).select("rid", "s", "e")
    if hot.limit(1).count():
        fine = _spread(_refined(with_text(open_.join(hot, "key", "left_semi")), length))
        out = out.unionByName(fine.filter(F.col("kind") == COVER).select("rid", "s", "e"))
        open_ = open_.join(hot, "key", "left_anti")
    return out.unionByName(_detail(with_text(open_), length).select("rid", "s", "e"))


def _merged(column: pa.Array) -> Iterator[list[tuple[int, int]]]:
    """The union of each row's spans in order; none for null. Spans stay
    numbers in arrays: a repetitive text has one for every byte."""
    count = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    s, e = (x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten())
    wide = int(e.max(initial=0)) + 2  # rows lie apart
    base = np.repeat(np.arange(len(count)) * wide, count)
    s, e = s + base, e + base
    order = np.argsort(s, kind="stable")
    s, e = s[order], np.maximum.accumulate(e[order])
    last = np.flatnonzero(np.concatenate([s[1:] > e[:-1], [True]])) if len(s) else np.zeros(0, np.int64)
    s, e = s[np.concatenate([[0], last[:-1] + 1])] if len(s) else s, e[last]
    ends = np.searchsorted(s, np.arange(1, len(count) + 1) * wide)
    for row, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends)):
        yield list(zip((s[a:b] - row * wide).tolist(), (e[a:b] - row * wide).tolist()))


def _joined(docs: DataFrame, length: int) -> DataFrame:
    """docs with the spans to remove."""
    spans = repeat_spans(docs, length).groupBy(F.col("rid").alias("__rid")).agg(F.collect_list(F.struct("s", "e")).alias("__spans"))
    return docs.withColumn("__rid", F.xxhash64("doc_id", "text")).join(spans, "__rid", "left").drop("__rid")


def removed(docs: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    def run(batches):
        for whole in batches:
            for b in B.slices(whole):
                out: list[list] = [[] for _ in range(4)]
                for text, spans in zip(b.column("text"), _merged(b.column("__spans"))):
                    data = memoryview(text.as_buffer() or b"") if text.is_valid else memoryview(b"")
                    kept, at = hashlib.sha256(), 0
                    for s, e in spans + [(len(data), len(data))]:
                        kept.update(data[at:s])
                        at = e
                    for to, v in zip(out, (len(data), sum(e - s for s, e in spans), len(spans), kept.hexdigest())):
                        to.append(v)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(v, t) for v, t in zip(out, (pa.int64(),) * 3 + (pa.string(),)))],
                                                 ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length)
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def whole_chars(data: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without characters that they cover in part."""
    out = []
    for s, e in spans:
        while s < e and data[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def drop_repeats(spark, docs: DataFrame, sf_dir: str, length: int = 200) -> DataFrame:
    """Pipeline stage: repeated bytes leave the texts (characters that a span
    covers in part stay); n_chars follows; other columns pass through."""
    def run(batches):
        for whole in batches:
            for b in B.slices(whole):
                texts = []
                for text, spans in zip(b.column("text"), _merged(b.column("__spans"))):
                    if not text.is_valid or not spans:
                        texts.append(text.as_py())
                        continue
                    data, at, kept = text.as_buffer().to_pybytes(), 0, []
                    for s, e in whole_chars(data, spans) + [(len(data), len(data))]:
                        kept.append(data[at:s])
                        at = e
                    texts.append(b"".join(kept).decode())
                names = [f.name for f in b.schema if f.name != "__spans"]
                yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field("text").type) if n == "text" else b.column(n) for n in names], names)

    out = _joined(docs, length).mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def query(spark, sf_dir: str) -> DataFrame:
    """Whole ``documents``, 200 bytes."""
    return removed(spark.read.parquet(f"{sf_dir}/documents.parquet"))

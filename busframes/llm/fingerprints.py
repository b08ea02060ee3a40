"""Bottom-k sketches of word shingles (native: SQL functions only).

A text's sketch is the sorted array of its k smallest distinct shingle hashes
(five words, 64-bit xxhash, signed order; a shorter text's whole sequence is
its one shingle). Sketches merge: the k smallest of two sketches' union are
the sketch of both parts together, so texts are sketched part by part (PART
words at a time, which bounds the arrays of hashes) and tables by groups
(``merged``). Sketches estimate

- resemblance: the share of the k smallest hashes of the union that both hold;
- distinct shingles: (k - 1) over the largest hash's place in the hash range;
- containment: resemblance times the union's distinct count over the text's.

All three are exact while the sketches are not full (fewer than k shingles).
With k = 128 the standard error of a resemblance is 0.045 at most.

The query pairs each document with the next by descending doc_id. Documents
fall into blocks: ranges of doc_id from a quantile sketch, a doc_id with many
rows cut by text hash. A block's first row also goes to the block before it,
so a window over each block sees every row's successor; texts move once.

Defined cases: null text is empty and has an empty sketch, whose likeness to
an empty one is 1 and to any other 0; null doc_ids come last; rows of one
doc_id follow each other by text hash; repeated rows follow each other; one
row alone is its own successor; texts of any length are sketched whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from busframes.operators.ranges import MAX_CUTS, quantile_cuts, range_number

WHITE = r"[\x20\x09-\x0D]+"
K = 128
WIDTH = 5
PART = 4096
BLOCK_ROWS = 256
NO_ID = -(1 << 63)


def _let(value: Column, body) -> Column:
    """``body`` over ``value`` evaluated once, even where body is a lambda."""
    return F.transform(F.array(value), body)[0]


def _none() -> Column:
    return F.array().cast("array<bigint>")


def _smallest(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def text_sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """The sketch of a text, merged over its parts."""
    def part(words: Column, n: Column, at: Column) -> Column:
        # the shingles that begin at the PART words from ``at`` on
        count = F.when(n < width, F.least(n, F.lit(1))).otherwise(F.least(F.lit(PART), n - at - (width - 1)))
        hashed = F.transform(F.slice(words, at + 1, PART + width - 1), lambda w: F.xxhash64(w))
        return F.when(count > 0, _let(hashed, lambda h: F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(width)])))).otherwise(_none())

    def whole(words: Column) -> Column:
        n = F.size(words)
        parts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(PART))
        return F.aggregate(parts, _none(), lambda held, at: _smallest(F.concat(held, part(words, n, at)), k))

    return _let(F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), ""), whole)


def union_sketch(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together; all hashes where neither is full."""
    both = F.sort_array(F.array_union(a, b))
    return F.when((F.size(a) < k) & (F.size(b) < k), both).otherwise(F.slice(both, 1, k))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the shingle sets, 0 to 1."""
    def share(u: Column) -> Column:
        common = F.filter(F.array_intersect(a, b), lambda x: x <= F.get(u, F.size(u) - 1))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(F.size(common) / F.size(u))

    return _let(union_sketch(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    place = (F.get(a, F.size(a) - 1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds, 0 to 1."""
    def share(u: Column) -> Column:
        common = resemblance(a, b, k) * F.when((F.size(a) < k) & (F.size(b) < k), F.size(u).cast("double")).otherwise(distinct_shingles(u, k))
        return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))

    return _let(union_sketch(a, b, k), share)


def fingerprint(a: Column) -> Column:
    """A sketch as text: 16 hex digits a hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def merged(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """(keys, sketch) of groups of parts. Equal hashes meet first, dealt by
    hash too; then each task keeps a group's k smallest before they travel,
    so no group, however large, comes to one task."""
    each = sketches.select(*keys, F.explode(column).alias("_h")).distinct()
    by = Window.partitionBy(*keys).orderBy("_h")
    least = each.withColumn("_n", F.row_number().over(by)).filter(F.col("_n") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def _blocks(docs: DataFrame, block_rows: int) -> DataFrame:
    """doc_id, text, _key, _hash, _block: ranges of (doc_id, text hash)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(NO_ID))
    cuts = quantile_cuts(rows, key, min(MAX_CUTS, rows.count() // block_rows + 1))
    rows = rows.select("*", key.alias("_key"), F.xxhash64("text").alias("_hash"))
    return rows.withColumn("_block", range_number(F.col("_key"), cuts, F.col("_hash")))


def with_next(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, text, sketch and next (text, sketch) of the document that
    follows by descending doc_id (after the last: the first)."""
    rows = _blocks(docs, block_rows)
    # one row a block, MAX_CUTS + 1 at most: its first goes to the block before it, too
    firsts = rows.groupBy("_block").agg(F.max(F.struct("_key", "_hash")).alias("first"))
    up = Window.orderBy("_block")
    to = F.coalesce(F.lead("_block").over(up), F.min("_block").over(up))
    firsts = firsts.select(F.col("first._key").alias("_k"), F.col("first._hash").alias("_h"), to.alias("_to"))
    dealt = rows.join(F.broadcast(firsts), (F.col("_key") == F.col("_k")) & (F.col("_hash") == F.col("_h")), "left")
    own, guest = F.struct(F.col("_block").alias("b"), F.lit(False).alias("guest")), F.struct(F.col("_to").alias("b"), F.lit(True).alias("guest"))
    places = F.explode(F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, guest)))
    dealt = dealt.select("doc_id", "text", "_key", "_hash", places.alias("_at")).select("doc_id", "text", "_key", "_hash", "_at.b", "_at.guest")
    sketched = dealt.repartition("b").withColumn("sketch", text_sketch(F.col("text")))
    order = Window.partitionBy("b").orderBy("guest", F.desc("_key"), F.desc("_hash"))
    return (sketched.withColumn("next", F.lead(F.struct("text", "sketch")).over(order)).filter(~F.col("guest"))
            .select("doc_id", "text", "sketch", "next"))


def edited_text(text: Column, other: Column) -> Column:
    """The last half of the text's code points replaced by the first as many
    (or all) of the other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def compared(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of each document and of its edited text, and its likeness
    to that and to the next document."""
    rows = with_next(docs, block_rows)
    edited = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "sketch", F.col("next.sketch").alias("next_sketch"),
                         edited_text(F.col("text"), F.col("next.text")).alias("edited"))
    both = edited.withColumn("edited_sketch", text_sketch(F.col("edited")))
    own, other = F.col("sketch"), F.col("edited_sketch")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(own).alias("fingerprint"),
                       fingerprint(other).alias("edited_fingerprint"), resemblance(own, other).alias("near_edited"),
                       resemblance(own, F.col("next_sketch")).alias("near_next"), distinct_shingles(own).alias("n_shingles"),
                       containment(own, other).alias("kept_in_edited"))


def query(spark, sf_dir: str) -> DataFrame:
    """All ``documents``."""
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))

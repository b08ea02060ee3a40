"""Text trace scan: log lines -> frames (module, ts ns, id, dir, len, data).

The scan is ``spark.read.text`` (splittable), a prefix filter and a split on
blanks: seconds, module, hex id, direction, ``d``, byte count, then that many
payload bytes (8 for classic frames, up to 64 for FD frames), in either hex
case; ``data`` is upper case. What follows the payload (bit counts and the
like) is ignored. Lines that pass the prefix filter but do not parse end up in
``rejects`` with a reason; a byte count that differs from the payload is one,
so a payload is never cut silently.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.functions.bits import hex_id_to_int, seconds_to_ns

FRAME_COLUMNS = ("module", "ts", "id", "dir", "len", "data")


@dataclass
class ParsedTrace:
    """Frames and rejects of one scan; ``rows`` holds both."""
    frames: DataFrame
    rejects: DataFrame
    rows: DataFrame | None = None


def keep_frame_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Frame lines start with a blank; headers and comments do not."""
    return lines.filter(F.col(col).startswith(" "))


def tokenize(col) -> F.Column:
    """Blank-separated tokens of a line."""
    col = F.col(col) if isinstance(col, str) else col
    plain = F.when(col.contains("\t") | col.contains("\r"), F.translate(col, "\t\r", "  ")).otherwise(col)
    return F.array_remove(F.split(plain, " "), "")


HEX_BYTES = "^[0-9A-Fa-f]{2}( [0-9A-Fa-f]{2})*$"


def parse_text_lines(lines: DataFrame, col: str = "value",
                     source_col: str | None = None) -> DataFrame:
    """Split and type each line; ``reject`` is null for good frames.

    The split runs inside a one-row ``inline`` (a Generate), and so do the
    checks: predicates on a Generate's columns cannot be pushed below it, so a
    later ``reject`` filter neither splits the line again nor repeats a check.
    """
    source = F.col(source_col) if source_col else F.lit(None).cast("string")
    split = lines.select(F.inline(F.array(F.struct(
        source.alias("source"), F.col(col).alias("line"), tokenize(col).alias("tokens")))))
    n = F.get("tokens", 5).try_cast("smallint")
    parsed = split.select(
        "source", "line", "tokens",
        F.size("tokens").alias("n_tokens"),
        F.get("tokens", 1).try_cast("smallint").alias("module"),
        seconds_to_ns(F.get("tokens", 0)).alias("ts"),
        hex_id_to_int(F.get("tokens", 2)).alias("id"),
        F.get("tokens", 3).alias("dir"),
        F.when(n >= 0, n).alias("len"),
    ).select("*", F.upper(F.array_join(F.slice("tokens", F.lit(7), F.coalesce("len", F.lit(0))), " ")).alias("data"),
             F.get("tokens", F.lit(6) + F.col("len")).alias("_next"))
    payload = F.col("data").rlike(HEX_BYTES) & (F.length("data") == 3 * F.col("len") - 1)
    longer = F.coalesce(F.col("_next").rlike("^[0-9A-Fa-f]{2}$"), F.lit(False))
    reason = (F.when((F.col("n_tokens") < 7) | ~F.lower(F.get("tokens", 4)).eqNullSafe(F.lit("d")), F.lit("too few tokens"))
              .when(F.col("ts").isNull(), F.lit("bad seconds"))
              .when(F.col("module").isNull(), F.lit("bad module"))
              .when(F.col("id").isNull(), F.lit("bad id"))
              .when(~F.lower("dir").isin("rx", "tx"), F.lit("bad direction"))
              .when(F.col("len").isNull(), F.lit("bad byte count"))
              .when(~payload | longer, F.lit("payload differs from byte count")))
    kept = [c for c in parsed.columns if c not in ("tokens", "_next")]
    return parsed.select(F.inline(F.array(F.struct(*kept, reason.alias("reject")))))


def split_parsed(parsed: DataFrame) -> ParsedTrace:
    frames = parsed.filter(F.col("reject").isNull()).select(*FRAME_COLUMNS)
    rejects = parsed.filter(F.col("reject").isNotNull()).select(
        "source", F.lit(None).cast("bigint").alias("position"),
        F.col("reject").alias("reason"), "line")
    return ParsedTrace(frames, rejects, parsed)


def read_text_trace(spark: SparkSession, path: str, order_by_ts: bool = False) -> ParsedTrace:
    """Scan a text trace file, directory or glob (any Hadoop URI)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source"))
    out = split_parsed(parse_text_lines(keep_frame_lines(lines), source_col="source"))
    if order_by_ts:
        out = ParsedTrace(out.frames.orderBy("ts"), out.rejects, out.rows)
    return out

"""Line de-duplication over overlapping windows of consecutive lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane import staging
from terravane.llm.names import unused

WINDOW = 3


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, at): every window but the first of its kind.

    First: smallest (doc_id, text hash, position); a null doc_id comes first. Windows are
    counted with map-side combining and the counts joined back, so a common window is never
    gathered; only its first place is kept.
    """
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.split("text", "\n").alias("lines"))
    last = F.size("lines") - window
    at = lines.where(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    # two hashes of the lines name a window: 128 bits
    parts = [F.get("lines", F.col("at") + k) for k in range(window)]
    keyed = at.select("doc_id", "text_hash", "at", F.xxhash64(*parts).alias("a"),
                      F.xxhash64(F.lit(window), *reversed(parts)).alias("b"))
    path = staging.fresh_path(docs.sparkSession, "line-windows")
    keyed.distinct().write.parquet(path)  # read twice; equal rows of docs count once
    keyed = docs.sparkSession.read.parquet(path)
    first = keyed.groupBy("a", "b").agg(
        F.min(F.struct("doc_id", "text_hash", "at")).alias("first"), F.count("*").alias("n")
    ).where("n > 1").select(F.col("a").alias("_a"), F.col("b").alias("_b"), "first")
    later = ~F.struct("doc_id", "text_hash", "at").eqNullSafe(F.col("first"))
    return keyed.join(first, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b"))).where(
        later).select("doc_id", "text_hash", "at")


def deduplicate_lines(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """docs without repeated lines, with n_lines and n_removed added.

    A run of `window` consecutive lines that occurred before is removed, all its lines;
    overlapping runs are merged. What occurred before is decided on the texts as they come, so
    the first occurrence always stays. Texts with fewer lines than the window have no window
    and stay. A null text stays null, with 0 lines; an empty text is one empty line. Rows that
    are equal in doc_id and text are one document that comes twice: both stay, alike. All other
    columns are kept; existing columns named n_lines or n_removed are replaced.
    """
    id_, hash_, at, gone_ = unused(docs, "id", "hash", "at", "gone")
    covered = repeated_windows(docs.select("doc_id", "text"), window).groupBy(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_)).agg(
        F.collect_set("at").alias(at))  # positions of one text
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*(F.col(f"`{c}`") for c in kept)).join(
        covered, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_)), "left")
    lines = F.split("text", "\n")
    gone = F.array_distinct(F.flatten(F.transform(
        at, lambda p: F.sequence(p, p + (window - 1)))))
    joined = joined.withColumn(gone_, gone)
    has = F.col(gone_).isNotNull()
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return joined.select(
        *(F.when(has, _without(lines, F.col(gone_))).otherwise(F.col("text")).alias("text")
          if c == "text" else F.col(f"`{c}`") for c in kept),
        n_lines.alias("n_lines"),
        F.when(has, F.size(gone_)).otherwise(0).cast("long").alias("n_removed"))


def _without(lines: Column, gone: Column) -> Column:
    """Lines whose positions are not in `gone`, with their line ends."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    # bound as a lambda variable, so that the text is split once and not once per line
    bound = F.array(F.struct(lines.alias("lines"), kept.alias("kept")))
    return F.get(F.transform(bound, lambda t: F.array_join(
        F.transform(t["kept"], lambda i: F.get(t["lines"], i)), "\n")), 0)

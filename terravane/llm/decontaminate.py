"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark are hashed and broadcast as a hash set of longs; every token
window of the training texts is hashed in the scan and probed against it, and each hit is
verified by comparing the words themselves. Only hits leave the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.names import unused

WINDOW = 10
#: Largest benchmark, in bytes of window text, that is broadcast; beyond, both sides shuffle.
BROADCAST_BYTES = 32 << 20
#: Equal rows that one task multiplies at most.
_RUN = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words once A-Z is lower-cased: all ASCII but digits and letters.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Spans of words in a text: runs of letters of any case, digits and non-ASCII characters.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased words; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, _GAP), "")


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(length, hash, gram, items): each different window and the items that hold it.

    An item with fewer words than the window is one window; an item without words has none.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item"),
                             words(F.col("text")).alias("w")).where(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(window))
    grams = items.select(
        "item", length.alias("length"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1),
                              lambda i: F.array_join(F.slice("w", i, length), " "))).alias("gram"))
    hashed = grams.groupBy("length", "gram").agg(F.collect_set("item").alias("items"))
    split = F.split("gram", " ")
    # the same hash as in window_probes(), by window length
    lengths = range(1, window + 1)
    code = F.coalesce(*(F.when(F.col("length") == n,
                               F.xxhash64(*(split[k] for k in range(n)))) for n in lengths))
    return hashed.select("length", code.alias("hash"), "gram", "items")


def window_probes(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per token window: (…, w, at, length, hash); per text also one with at = -1.

    The positions are exploded first and hashed afterwards, so that the hash of a window is
    compiled code over the word array and not an interpreted lambda.
    """
    last = F.size("w") - (min(lengths) if lengths else 1)
    at = docs.select("*", F.explode(F.sequence(
        F.lit(-1), F.greatest(last, F.lit(-1)), F.lit(1))).alias("at"))
    if not lengths:
        return at.where("at < 0").select("*", F.lit(0).alias("length"),
                                         F.lit(None).cast("long").alias("hash"))

    def code(n: int) -> Column:
        whole = (F.col("at") >= 0) & (F.col("at") + n <= F.size("w"))
        return F.when(whole, F.xxhash64(*(F.get("w", F.col("at") + k) for k in range(n))))

    if len(lengths) == 1:
        return at.select("*", F.lit(lengths[0]).alias("length"), code(lengths[0]).alias("hash"))
    each = F.array(*(F.struct(F.lit(n).alias("length"), code(n).alias("hash")) for n in lengths))
    return at.select("*", F.explode(each).alias("x")).select(
        *at.columns, "x.length", "x.hash").where("hash is not null or at < 0")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, copies, n_words, spans, items): one row per different (doc_id, text).

    spans: (at, length) of every occurrence of a window, in words counted from 0, sorted.
    items: the items with a window in the text, sorted as strings. A null or wordless text
    has no words and no spans. copies: how many rows are equal in both. Null
    item_ids are not listed, though their windows hit. Columns other than doc_id, text and
    item_id, text are not read.
    """
    windows = benchmark_windows(benchmark, window)
    stats = windows.groupBy("length").agg(
        F.sum(F.octet_length("gram") + 40 + 24 * F.size("items")).alias("bytes")).collect()
    lengths = sorted(r["length"] for r in stats)  # at most `window` rows
    small = sum(r["bytes"] for r in stats) <= broadcast_bytes
    base = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    base = base.select("doc_id", "text_hash", words(F.col("text")).alias("w"))
    probes = window_probes(base, lengths)
    if not small:  # rows of a shuffle carry their own words only
        probes = probes.select(
            "doc_id", "text_hash", "hash", "length", F.when(F.col("at") >= 0, 0).otherwise(-1).alias("from"),
            "at", F.when(F.col("at") < 0, F.array_repeat(F.lit(""), F.size("w"))).otherwise(
                F.slice("w", F.greatest(F.col("at"), F.lit(0)) + 1, F.col("length"))).alias("w"))
    else:
        probes = probes.withColumn("from", F.col("at"))
    side = windows.select(F.col("hash").alias("b_hash"), "gram", "items")
    # the words are compared in the join itself, so a hash shared by two windows loses nothing
    found = F.array_join(F.slice("w", F.greatest(F.col("from"), F.lit(0)) + 1, F.col("length")), " ")
    # equal, written as two prefixes: as an equality it would become a second join key, which
    # is computed for every window instead of for those whose hash is found
    same = (F.col("hash") == F.col("b_hash")) & (
        found.startswith(F.col("gram")) & F.col("gram").startswith(found))
    side = F.broadcast(side) if small else side.hint("merge")
    hits = probes.join(side, same, "left").where("gram is not null or at < 0")
    # the words stay behind: beyond 128 texts a task's aggregation holds its input rows until they are
    # sorted, and each hit would hold all words of its text once more
    hits = hits.select("doc_id", "text_hash", "items", F.when(F.col("at") < 0, F.size("w")).alias("n_words"),
                       F.when(F.col("at") >= 0, F.struct("at", "length")).alias("span"))
    return hits.groupBy("doc_id", "text_hash").agg(
        F.count("n_words").alias("copies"),  # one such probe per row
        F.max("n_words").cast("long").alias("n_words"),
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))


def merged_spans(spans: Column) -> Column:
    """Sorted spans joined where they touch or overlap: structs (at, end)."""
    step = F.aggregate(
        spans, F.array().cast("array<struct<at:int,end:int>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= s["at"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                F.element_at(done, -1)["at"].alias("at"),
                F.greatest(F.element_at(done, -1)["end"], s["at"] + s["length"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(
            s["at"].alias("at"), (s["at"] + s["length"]).alias("end"))))))
    return F.when(F.size(spans) > 0, step).otherwise(
        F.array().cast("array<struct<at:int,end:int>>"))


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated): one row per row.

    Equal rows are searched as one and multiplied at the end, many of them by several tasks.
    """
    found = contamination(docs, benchmark, **options)
    runs = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_RUN))
    found = found.withColumn("from", F.explode(runs)).repartition("doc_id", "text_hash", "from")
    found = found.withColumn("copy", F.explode(F.sequence(F.col("from"), F.least(
        F.col("from") + _RUN, F.col("copies")) - 1)))
    covered = F.array_size(F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["at"], s["at"] + s["length"] - 1)))))
    n_hit = F.when(F.size("spans") > 0, covered).otherwise(F.lit(0)).cast("long")
    return found.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, action: str = "spans",
                  **options) -> DataFrame:
    """The documents without what the benchmark also holds; all columns are kept.

    action "documents": contaminated rows go. action "spans": the words of every hit are cut
    out, with what stands between them; text outside a hit stays as it is. Rows with a null
    text or without hits are unchanged. n_chars, if there, follows the new text.
    """
    if action not in ("spans", "documents"):
        raise ValueError(action)
    id_, hash_, spans = unused(docs, "id", "hash", "spans")
    found = contamination(docs, benchmark, **options).where(F.size("spans") > 0).select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.col("spans").alias(spans))
    key = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    if action == "documents":
        return docs.join(found, key, "left_anti")
    joined = docs.join(found, key, "left")
    cut = joined.withColumn("text", F.when(
        F.col(spans).isNotNull(), without_spans(F.col("text"), merged_spans(F.col(spans)))
    ).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.col(spans).isNotNull(), F.length("text").cast(
            docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return cut.select(*(F.col(f"`{c}`") for c in docs.columns))


def without_spans(text: Column, spans: Column) -> Column:
    """Text without the words of the merged spans (at, end), counted from 0.

    The text is split into words and the gaps around them: gap k stands before word k.
    """
    bound = F.array(F.struct(
        F.regexp_extract_all(text, F.lit(f"({_WORD})"), 1).alias("tokens"),
        F.split(text, _WORD).alias("gaps"),  # one more than words: it starts and ends with a gap
        spans.alias("spans")))
    # bound as a lambda variable, so that the text is split once and not once per word
    return F.get(F.transform(bound, lambda t: _joined(t["tokens"], t["gaps"], t["spans"])), 0)


def _joined(tokens: Column, gaps: Column, spans: Column) -> Column:
    edges = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"]))
    stops = F.concat(F.transform(spans, lambda s: s["at"]), F.array(F.size(tokens)))
    kept = F.transform(F.arrays_zip(edges.alias("a"), stops.alias("b")), lambda e: F.array_join(
        F.flatten(F.transform(
            F.filter(F.sequence(e["a"], F.greatest(e["b"], e["a"])), lambda k: k < e["b"]),
            lambda k: F.array(
                F.when((k == e["a"]) & (k > 0), F.lit("")).otherwise(gaps[k]), tokens[k]))), ""))
    return F.trim(F.concat(F.array_join(F.filter(kept, lambda p: p != ""), " "), F.element_at(gaps, -1)))

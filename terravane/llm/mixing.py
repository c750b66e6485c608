"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's texts are shuffled (by the MD5 of the doc_id), laid end to end and cut into
blocks of equally many words. A schedule of slots decides which source gives the next block:
slot j has the golden-ratio point frac(j * phi), mapped through the cumulative target shares.
The slots of a source are ranked; rank k takes block k, and after the last block the first one
again. A source gives exactly floor(target) words: its last slot is cut, slots beyond its
quota are skipped, and slots that the points leave short are appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane import staging

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2
BLOCK_WORDS = 64
#: frac(phi) * 2^32: points are exact integers modulo 2^32.
_GOLDEN = 2654435769
_CHUNK = 1 << 16
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources by code point, null last, get the weights in turn. Targets are the smaller of
    `repeats` times the source's size and a common level times its weight, where the level
    makes them sum to `share` times all sizes: what handing the excess on by weight ends at.
    One row per source goes through a single task; texts and documents do not.
    """
    if share > repeats:
        raise ValueError("the share cannot be more than the repeats")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                          (number % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn(
        "cap", (F.col("source_size") * repeats).cast("double")).withColumn(
        "total", F.sum("source_size").over(everything) * F.lit(share))
    # in the order in which they reach their caps, the capped ones come first
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    above = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per = per.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(above), F.lit(0.0)))
                         / F.sum("weight").over(rest))
    per = per.withColumn("open", F.col("cap") > F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("open"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias(
        "level")))).over(everything)["level"]
    return per.withColumn("final", level).select(
        "source", "source_size",
        F.when(F.col("final").isNull(), F.col("cap")).otherwise(
            F.least(F.col("cap"), F.col("final") * F.col("weight"))).alias("target"))


def layout(docs: DataFrame, *, bucket_docs: int = 20_000) -> DataFrame:
    """docs (doc_id, source, size) with `begin`: where its words start in the shuffled source.

    The order is that of the MD5 of the doc_id, then doc_id and `tie`. Words before a document
    are summed in two steps, over hash ranges and inside one, so no source is sorted in one task.
    """
    count = docs.count()
    digits = 1
    while 16**digits * bucket_docs < count:
        digits += 1
    keyed = docs.withColumn("_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                            ).withColumn("_range", F.substring("_order", 1, digits))
    ranges = keyed.groupBy("source", "_range").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "_range",
                           F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source", "_range").orderBy("_order", "doc_id", "tie").rowsBetween(
        Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    ranges = ranges.withColumnsRenamed({"source": "_s", "_range": "_r"})
    return keyed.join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r"))
                      ).withColumn("begin", F.col("_base") + F.col("_in")).drop(
        "_order", "_range", "_in", "_base", "_s", "_r")


def schedule(targets: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, source, block, words): the blocks in the order in which they are to be read.

    words: how many of the block's first words are taken.
    """
    spark = targets.sparkSession
    whole = F.floor("target").cast("long")
    blocks = F.ceil(F.col("source_size") / block_words).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    left = whole - passes * F.col("source_size")
    per = targets.where(whole > 0).select(
        "source", "source_size", blocks.alias("blocks"), (passes * blocks + F.ceil(
            left / block_words)).cast("long").alias("quota"),
        passes.cast("long").alias("passes"), left.cast("long").alias("left"))
    upto = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("quota").over(Window.partitionBy())
    share = F.sum("quota").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # cumulative shares of the slots, as integers of 32 bits
    per = per.withColumn("high", F.floor(share / total * 2**32)).withColumn(
        "low", F.coalesce(F.lag("high").over(upto), F.lit(0))).withColumn("total", total)
    slots, sources = per.agg(F.coalesce(F.max("total"), F.lit(0)), F.count("*")).first()
    # one row per source, with its interval of points; a point finds its interval by the cell
    # of the circle it lies in, so the join has a key; cells are finer than the sources
    step = max(1, 2**32 // max(4096, 16 * sources))
    cells = per.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("low") / step), F.floor((F.col("high")) / step))))
    points = spark.range(slots).select(
        F.col("id").alias("slot"), ((F.col("id") + 1) % 2**31 * _GOLDEN % 2**32).alias("point")
    ).withColumn("cell", F.floor(F.col("point") / step))
    drawn = points.join(cells, "cell").where("point >= low and point < high").select(
        "slot", "source", F.floor(F.col("slot") / _CHUNK).alias("chunk"))
    # ranks: slots of the source in earlier chunks, then inside the chunk
    counts = drawn.groupBy("source", "chunk").count()
    earlier = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("_s"), F.col("chunk").alias("_c"), F.coalesce(
        F.sum("count").over(earlier), F.lit(0)).alias("base"), "count")
    inside = Window.partitionBy("source", "chunk").orderBy("slot")
    ranked = drawn.withColumn("in", F.row_number().over(inside) - 1).join(
        counts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c"))).select(
        "slot", "source", (F.col("base") + F.col("in")).alias("rank"))
    drawn_total = counts.groupBy("_s").agg(F.sum("count").alias("had"))
    short = per.join(drawn_total, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn(
        "had", F.coalesce("had", F.lit(0))).where("had < quota").select(
        F.lit(slots).cast("long").alias("slot"), "source",
        F.explode(F.sequence(F.col("had"), F.col("quota") - 1)).alias("rank"))
    ranked = ranked.unionByName(short)
    own = per.select(F.col("source").alias("_s"), "quota", "blocks", "source_size", "passes", "left")
    block = F.col("rank") % F.col("blocks")
    full = F.least(F.lit(block_words), F.col("source_size") - block * block_words)
    cut = F.when(F.floor(F.col("rank") / F.col("blocks")) == F.col("passes"),
                 F.least(full, F.col("left") - block * block_words)).otherwise(full)
    return ranked.join(own, F.col("source").eqNullSafe(F.col("_s"))).where("rank < quota").select(
        "slot", "source", block.alias("block"), cut.cast("long").alias("words"))


def mix(docs: DataFrame, *, weights: tuple = WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
        block_words: int = BLOCK_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pieces, targets, placed) of a table with doc_id, text, source.

    pieces: (slot, source, block, doc_id, tie, from, words): the mixed stream; a piece is a run
    of `words` words of a document, from word number `from`. placed: (doc_id, source, size,
    tie, begin). A null or wordless text has size 0 and gives no piece. `tie` (the hash of the
    text) tells rows with equal doc_ids apart; rows that are equal in both are laid out one
    after the other and share their pieces' identity.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source",
                        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    path = staging.fresh_path(docs.sparkSession, "sizes")
    sized.write.parquet(path)  # read several times, so the texts are read once
    sized = docs.sparkSession.read.parquet(path)
    targets = source_targets(sized, weights=weights, share=share, repeats=repeats)
    placed = layout(sized)
    slots = schedule(targets, block_words=block_words)
    held = placed.where("size > 0").select(
        "doc_id", "tie", F.col("source").alias("_s"), "begin", (F.col("begin") + F.col("size")).alias("end"),
        F.explode(F.sequence(F.floor(F.col("begin") / block_words),
                             F.floor((F.col("begin") + F.col("size") - 1) / block_words))).alias("_b"))
    start = F.greatest("begin", F.col("block") * block_words)
    stop = F.least(F.col("end"), F.col("block") * block_words + F.col("words"))
    # slots of a block are few (one per repeat): pairs of sources and blocks spread evenly
    pieces = slots.join(held, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))
                        ).where(stop > start).select(
        "slot", "source", "block", "doc_id", "tie", (start - F.col("begin")).alias("from"),
        (stop - start).alias("words"))
    return pieces, targets, placed


def _taken(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, tie, source, size, source_size, target, taken): one row per row of docs."""
    pieces, targets, placed = mix(docs, **options)
    taken = pieces.groupBy(F.col("doc_id").alias("_d"), F.col("tie").alias("_t"),
                           F.col("source").alias("_s")).agg(F.sum("words").alias("sum"))
    same = Window.partitionBy("doc_id", "tie", "source")
    placed = placed.withColumn("copies", F.count("*").over(same)).withColumn(
        "copy", F.row_number().over(same.orderBy("begin")))
    joined = placed.join(taken, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("tie") == F.col("_t"))
                         & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_d", "_t", "_s")
    whole = F.coalesce("sum", F.lit(0))
    share = F.floor(whole / F.col("copies")) + F.when(
        F.col("copy") <= whole % F.col("copies"), 1).otherwise(0)
    targets = targets.withColumnRenamed("source", "_s")
    return joined.join(targets, F.col("source").eqNullSafe(F.col("_s"))).select(
        "doc_id", "tie", "source", "size", "source_size", "target", share.cast("long").alias("taken"))


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per row of docs.

    Rows that are equal in doc_id, text and source get equal shares of what they give together,
    the first ones one word more if it does not divide.
    """
    return _taken(docs, **options).drop("tie", "source")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with the texts that the mix takes: one row per document, all columns kept.

    Whole rounds through a document give its text as it is, once per round, on lines of their
    own; the document where a source's quota ends gives its first words last. Documents from
    which nothing is taken go; n_chars follows the new text. Rows equal in doc_id, text and
    source become one row with what they give together.
    """
    taken = _taken(docs.select("doc_id", "text", "source"), **options).groupBy(
        F.col("doc_id").alias("_d"), F.col("tie").alias("_t"), F.col("source").alias("_s"), "size").agg(
        F.sum("taken").alias("taken")).where("taken > 0")
    # the row is one column here, so that no name of docs can clash
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                      F.xxhash64("text").alias("hash"), F.col("source").alias("of"))
    own = own.dropDuplicates(["id", "hash", "of"])
    joined = own.join(taken, F.col("id").eqNullSafe(F.col("_d")) & (F.col("hash") == F.col("_t"))
                      & F.col("of").eqNullSafe(F.col("_s")))
    text = F.col("row.text")
    rounds = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    words = F.slice(F.regexp_extract_all(text, F.lit(f"({_WORD})"), 1), 1, rest)
    parts = F.concat(F.array_repeat(text, rounds),
                     F.when(rest > 0, F.array(F.array_join(words, " "))).otherwise(
                         F.array().cast("array<string>")))
    mixed = joined.select(F.col("row").withField("text", F.array_join(parts, "\n")).alias("row"))
    if "n_chars" in docs.columns:
        mixed = mixed.select(F.col("row").withField(
            "n_chars", F.length("row.text").cast(docs.schema["n_chars"].dataType)).alias("row"))
    return mixed.select("row.*")

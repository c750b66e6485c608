"""Sharding by a hierarchical weighted hash tree.

A tree has regions, their racks and the racks' shards. A document descends it: at every level
each child draws -ln(u) / weight, u a hash of the document's key and the child's path in (0, 1),
and the smallest draw wins; the weight of a region or rack is the sum of its shards. A child
wins with a chance in proportion to its weight. If weights change, only children whose weight
changed draw otherwise, so rows move only into or out of those subtrees; inside a subtree that
kept its weights every row that stays keeps its shard. A shard that is added as a region of its
own takes rows only into itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane import staging

SHARDS = 40
PER_RACK = 5
RACKS = 4
#: What a document takes in a shard besides its text.
ROW_BYTES = 16
_DRAW_DIGITS = 13


@dataclass(frozen=True)
class Tree:
    """regions: for each region its racks, for each rack the (shard, weight) pairs.

    Paths of nodes are places ("1/0/3"), so a tree may only be extended at its ends if rows are
    to stay. Weights are at least 0; a shard of weight 0 takes nothing.
    """
    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    def __post_init__(self):
        weights = [w for region in self.regions for rack in region for _, w in rack]
        if any(not 0 <= w < float("inf") for w in weights) or not sum(weights) > 0:
            raise ValueError("weights are finite, at least 0 and not all 0")

    def nodes(self) -> list[list[tuple[str, float, int]]]:
        """Children (path, weight, next) of each inner node, the root first; next: a node's number
        or, below a rack, the shard."""
        inner: list[list[tuple[str, float, int]]] = [[]]
        for r, region in enumerate(self.regions):
            racks = []
            for k, rack in enumerate(region):
                leaves = [(f"{r}/{k}/{s}", float(w), shard) for s, (shard, w) in enumerate(rack) if w > 0]
                if leaves:
                    inner.append(leaves)
                    racks.append((f"{r}/{k}", sum(x[1] for x in leaves), len(inner) - 1))
            if racks:
                inner.append(racks)
                inner[0].append((f"{r}", sum(x[1] for x in racks), len(inner) - 1))
        return inner

    def grown(self, shard: int, weight: float = 1.0) -> Tree:
        """One more shard, as a region of its own."""
        return Tree((*self.regions, (((shard, weight),),)))


def even_tree(shards: int = SHARDS, *, per_rack: int = PER_RACK, racks: int = RACKS) -> Tree:
    """Shards 0, 1, ... of weight 1, in racks of `per_rack` and regions of `racks` racks."""
    in_racks = [tuple((s, 1.0) for s in range(i, min(i + per_rack, shards)))
                for i in range(0, shards, per_rack)]
    return Tree(tuple(tuple(in_racks[i:i + racks]) for i in range(0, len(in_racks), racks)))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key (null: as the empty text), by key and tree alone."""
    kind = "array<array<struct<path:string,weight:double,next:int>>>"
    nodes = F.array(*(F.array(*(F.struct(F.lit(p).alias("path"), F.lit(w).alias("weight"), F.lit(n).alias(
        "next")) for p, w, n in children)) for children in tree.nodes())).cast(kind)
    text = F.coalesce(key.cast("string"), F.lit(""))

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(text, F.lit("@"), child["path"])), 1, _DRAW_DIGITS)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_DRAW_DIGITS)
        return -F.log(u) / child["weight"]

    at = F.lit(0)
    for _ in range(3):  # region, rack, shard
        drawn = F.transform(F.get(nodes, at), lambda c: F.struct(
            draw(c).alias("draw"), c["path"].alias("path"), c["next"].alias("next")))
        at = F.array_min(drawn)["next"]
    return at


def assign(docs: DataFrame, tree: Tree, *, column: str = "shard") -> DataFrame:
    """docs with the shard of each row added; a column of that name is replaced.

    No shuffle. Rows with equal doc_ids share a shard, and so do all rows without one.
    """
    return docs.withColumn(column, shard_of(F.col("doc_id"), tree))


def document_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def write_shards(docs: DataFrame, path: str, tree: Tree, *, file_rows: int = 200_000) -> None:
    """docs as Parquet in one folder per shard (`shard=N`), in files of about `file_rows` rows.

    Rows are dealt by shard and a hash of the row, so a large shard is several tasks; equal rows
    share a task, which writes them as a stream. Reading adds the column `shard`; docs must not
    have one.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("docs have a column named shard")
    parts = max(1, -(-docs.count() // file_rows))
    per_shard = max(1, round(parts / max(len({n for c in tree.nodes() for _, _, n in c}), 1)))
    names = list(docs.columns)
    dealt = assign(docs, tree).repartition(parts, "shard", F.pmod(F.xxhash64(*(
        F.col(f"`{c}`") for c in names)), F.lit(per_shard)))
    dealt.write.option("maxRecordsPerFile", file_rows).partitionBy("shard").parquet(path)


def slots(docs: DataFrame, tree: Tree, grown: Tree | None = None, *, range_docs: int = 20_000,
          run: int = 1 << 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, grown_shard): one row per row of docs.

    size: UTF-8 bytes of the text (null: none) plus 16. slot: place in the shard, gapless from 0,
    by the MD5 of the doc_id, then doc_id, size and checksum. grown_shard: the shard in `grown`.
    Rows that agree in doc_id, size and checksum are counted first and get consecutive slots, so
    they needn't meet; each shard is numbered in hash ranges of about `range_docs` such groups,
    after the rows before each range. Other columns are not read.
    """
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_size(F.col("text")).alias("size"),
                        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    path = staging.fresh_path(spark, "shard-rows")
    known.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies")).write.parquet(path)
    groups = spark.read.parquet(path)  # the texts are read once
    digits, shards = 1, len({n for c in tree.nodes() for _, _, n in c})
    while 16**digits * shards * range_docs < groups.count():
        digits += 1
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    placed = assign(groups, tree).withColumn(
        "grown_shard", shard_of(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")).withColumn(
        "order", order).withColumn("range", F.substring("order", 1, digits))
    sums = placed.groupBy("shard", "range").agg(F.sum("copies").alias("in_range"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("shard", "range", F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard", "range").orderBy(
        "order", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    numbered = placed.join(sums, ["shard", "range"]).withColumn("first", F.col("base") + F.col("inside"))
    # many copies are dealt out in runs before they become rows
    runs = numbered.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(run))))
    runs = runs.repartition("shard", "range", "first", "from")
    return runs.withColumn("slot", F.explode(F.sequence(
        F.col("first") + F.col("from"),
        F.col("first") + F.least(F.col("from") + run, F.col("copies")) - 1))).select(
        "doc_id", "size", "text_crc32", "shard", "slot", "grown_shard")

"""Lookups and equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane import dimensions
from terravane.functions.strings import strip_lower
from terravane.operators.dedup import ORDINAL


def lookup(df: DataFrame, dimension: DataFrame, key: Column | str, dim_key: str,
           value: str, alias: str) -> DataFrame:
    """Left lookup of one value by a key that is unique in the dimension.

    Unmatched rows get NULL. No hint is given: Spark broadcasts the dimension when its known size allows and
    shuffles both sides otherwise.
    """
    key = F.col(key) if isinstance(key, str) else key
    dim = dimension.select(F.col(dim_key).alias("_dim_key"), F.col(value).alias("_dim_value"))
    joined = df.join(dim, key == F.col("_dim_key"), "left")
    return joined.withColumn(alias, F.col("_dim_value")).drop("_dim_key", "_dim_value")


def fixed_lookup(df: DataFrame, dimension: DataFrame, key: Column | str, dim_key: str,
                 value: str, alias: str) -> DataFrame:
    """``lookup`` against one of the package's own dimensions (at most 300 rows)."""
    return lookup(df, F.broadcast(dimension), key, dim_key, value, alias)


def add_city_code(df: DataFrame, city: str, alias: str = "CountryISO") -> DataFrame:
    dim = dimensions.city_codes(df.sparkSession)
    return fixed_lookup(df, dim, city, "city", "iso3", alias)


def add_listed_country_code(df: DataFrame, country: str, alias: str = "CountryISO") -> DataFrame:
    dim = dimensions.country_codes(df.sparkSession)
    return fixed_lookup(df, dim, country, "country", "iso3", alias)


def add_country_code(df: DataFrame, country: str, alias: str = "CountryISO",
                     corrections: DataFrame | None = None,
                     register: DataFrame | None = None) -> DataFrame:
    """Country name in any spelling known to the register or the corrections -> code."""
    dim = dimensions.country_name_codes(df.sparkSession, corrections, register)
    join = fixed_lookup if corrections is None and register is None else lookup
    return join(df, dim, strip_lower(country), "name_key", "alpha3", alias)


def add_coordinates(df: DataFrame, city: str,
                    cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with latitude and longitude, rows whose city is unknown)."""
    known = F.broadcast(dimensions.cities(df.sparkSession)) if cities is None else cities
    known = known.select(F.col("city").alias("_city"), "latitude", "longitude")
    found = df.join(known, F.col(city) == F.col("_city"), "inner").drop("_city")
    return found, lookup_rejects(df, known, city, "_city")


def lookup_rejects(df: DataFrame, dimension: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Rows of ``df`` without a partner in the dimension."""
    dim = dimension.select(F.col(dim_key).alias("_dim_key"))
    return df.join(dim, F.col(key) == F.col("_dim_key"), "left_anti")


def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
               match_nulls: bool = False, suffixes: tuple[str, str] = ("_x", "_y"),
               hot_share: float | None = None, salts: int = 32,
               null_salts: int = 1, block: int = 0, parts: int = 1) -> DataFrame:
    """Many-to-many inner equi-join with suffixes for clashing columns.

    ``match_nulls`` lets missing keys pair with each other. Columns clash when their
    names differ at most by case. Spark picks the join kind and splits skewed
    partitions at run time; ``hot_share`` additionally salts every key that holds more
    than that share of the left rows (at most ``1 / hot_share`` keys can, which bounds
    the broadcast list of hot keys). ``null_salts`` deals the left rows with a missing key
    out to so many parts, if missing keys pair; their partners are copied to each part.

    ``block`` is for keys with many rows on both sides, whose pairs far outnumber the rows: up
    to so many left rows of a key are joined as one, see ``_block_join``. ``parts`` then deals the
    left rows of every key out to so many groups; the right rows are copied to each.
    """
    keys = list(keys)
    folded = {k.lower() for k in keys}
    clash = ({c.lower() for c in left.columns} & {c.lower() for c in right.columns}) - folded
    left = left.withColumnsRenamed(
        {c: c + suffixes[0] for c in left.columns if c.lower() in clash})
    right = right.withColumnsRenamed(
        {c: c + suffixes[1] for c in right.columns if c.lower() in clash}
        | {k: f"_right_{k}" for k in keys})
    output = left.columns + [c for c in right.columns if not c.startswith("_right_")]
    if block:
        if hot_share is not None or null_salts > 1:
            raise ValueError("block deals out by parts only")
        return _block_join(left, right, keys, match_nulls, block, parts).select(*output)

    def pairs(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b)) if match_nulls else F.col(a) == F.col(b)

    condition = [pairs(k, f"_right_{k}") for k in keys]
    if hot_share is not None:
        left, right = _salted(left, right, keys, hot_share, salts)
        condition.append(F.col("_salt") == F.col("_right_salt"))
    if match_nulls and null_salts > 1:
        left, right = _nulls_salted(left, right, keys, null_salts)
        condition.append(F.col("_part") == F.col("_right_part"))
    return left.join(right, reduce(lambda a, b: a & b, condition), "inner").select(*output)


def _block_join(left: DataFrame, right: DataFrame, keys: list[str], match_nulls: bool,
                block: int, parts: int) -> DataFrame:
    """The pairs of both sides, in an order that files can hold in few bytes.

    The tasks follow ``spark.sql.shuffle.partitions`` and not the bytes of the two sides, which say
    nothing of their pairs. The left rows of a key and part lie in blocks; a right row meets the
    rows of a block one after the other. So the values of the right row come in runs, and those
    of the block again and again, close together. Which rows share a block does not change the
    pairs, and blocks are made in the task that joins them. Memory holds one block, and the right
    rows of one key and part. Spark splits no skewed partition of this join; ``parts`` does.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame, prefix: str, part: Column) -> DataFrame:
        names = [f"{prefix}{k}" for k in keys]
        if not match_nulls:
            df = df.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in names]))
        # within a struct, missing values equal each other; the join then needs no other key
        key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(names)])
        if parts > 1:
            df = df.withColumn(f"{prefix}_part", part)
        by = [key, *([F.col(f"{prefix}_part")] if parts > 1 else [])]
        return df.repartition(tasks, *by).withColumn(f"{prefix}_key", key)

    groups = ["_key", "_part"] if parts > 1 else ["_key"]
    place = F.monotonically_increasing_id()  # of the row in its task
    blocks = (dealt(left, "", _row_salt(left, parts) if parts > 1 else F.lit(0))
              .select(*groups, F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_row"))
              .sortWithinPartitions(*groups).groupBy(*groups, F.floor(place / block).alias("_block"))
              .agg(F.collect_list("_row").alias("_rows")))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))
    others = dealt(right, "_right_", F.explode(every)).hint("merge")
    same = [F.col(c) == F.col(f"_right_{c}") for c in groups]
    values = [F.col(f"`{c}`") for c in right.columns]
    return blocks.join(others, reduce(lambda a, b: a & b, same), "inner").select(
        *values, F.explode("_rows").alias("_row")).select("_row.*", *values)


def _row_salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` for each row, the same again if its task is recomputed.

    It comes from the row's place in its file where the frame still shows it, so that equal rows
    are spread too; else from the landed ordinal, else from all values of the row.
    """
    places = (["_metadata.file_path", "_metadata.row_index"], [f"`{ORDINAL}`"], [f"`{c}`" for c in df.columns])
    for columns in places:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts))
        try:
            df.select(salt)  # is resolved at once
        except AnalysisException:
            continue
        return salt
    return F.lit(0).cast("bigint")


def _nulls_salted(left: DataFrame, right: DataFrame, keys: list[str],
                  salts: int) -> tuple[DataFrame, DataFrame]:
    """Spread the left rows with a missing key; needs no pass to find the key that is hot."""
    def incomplete(prefix: str) -> Column:
        return reduce(lambda a, b: a | b, [F.col(f"{prefix}{k}").isNull() for k in keys])

    zero = F.lit(0).cast("bigint")
    salt = _row_salt(left, salts)
    every = F.sequence(zero, F.lit(salts - 1).cast("bigint"))
    return (left.withColumn("_part", F.when(incomplete(""), salt).otherwise(zero)),
            right.withColumn("_right_part", F.explode(
                F.when(incomplete("_right_"), every).otherwise(F.array(zero)))))


def _salted(left: DataFrame, right: DataFrame, keys: list[str], hot_share: float,
            salts: int) -> tuple[DataFrame, DataFrame]:
    """Spread the hot keys of ``left`` over salts and copy their partners to each salt."""
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    hot = F.broadcast(
        counts.filter(F.col("_n") > total * hot_share)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    )

    def marked(df: DataFrame, prefix: str) -> DataFrame:
        on = [F.col(f"{prefix}{k}").eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
        return (df.join(hot, reduce(lambda a, b: a & b, on), "left")
                .drop(*[f"_hot_{k}" for k in keys]))

    left = marked(left.withColumn("_salt", _row_salt(left, salts)), "").withColumn(
        "_salt", F.when(F.col("_hot"), F.col("_salt")).otherwise(F.lit(0).cast("bigint"))).drop("_hot")
    all_salts = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    right = marked(right, "_right_").withColumn(
        "_right_salt",
        F.explode(F.when(F.col("_hot"), all_salts)
                  .otherwise(F.array(F.lit(0).cast("bigint"))))).drop("_hot")
    return left, right


def null_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows have a missing value in each join key."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in keys])

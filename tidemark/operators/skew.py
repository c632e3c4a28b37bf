"""Heavy keys: finding them, and joining past them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A key with at least one row in HOT_KEYS is heavy; there cannot be more than HOT_KEYS such keys.
HOT_KEYS = 4096
SALTS = "_salts"
_KEYLESS_SALTS = 1024
UNFOLD_PARTS = 256


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that hold at least 1/4096 of the rows, and into how many parts (``_salts``) each must be cut
    so that no part holds more than that; 4096 rows at most.

    Keys are counted with map-side combine and stay spread by key; only the total is one number.
    """
    total = df.agg(F.count(key)).scalar()
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    heavy = counted.filter((F.col("_n") > 1) & (F.col("_n") * HOT_KEYS >= total))
    return heavy.select(key, F.ceil(F.col("_n") * HOT_KEYS / F.greatest(total, F.lit(1))).cast("bigint").alias(SALTS))


def spread_to_unfold(df: DataFrame, *by: str) -> DataFrame:
    """``df`` by hash of ``by`` (evenly without any), in 256 parts or as many as the session shuffles into if these are more.

    For rows that become many each in the same task.  Adaptive execution sizes parts by what is shuffled, which
    says nothing about what comes out of them; a number that is given is kept.
    """
    parts = max(UNFOLD_PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *by)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner", spread_by: Sequence[str] = (),
                hot: DataFrame | None = None) -> DataFrame:
    """Join on ``key`` with the heavy keys of ``left`` spread over as many tasks as their share asks for.

    Rows of ``right`` are repeated for each part of a heavy key only; left rows without a key
    match nothing and are spread as well.  Each left row meets
    all of its right rows under its own salt, so inner, left, left_semi and left_anti joins
    come out as without the salt.  The adaptive skew join does the same at run time, but not
    where an aggregate on the same key follows; this one always applies.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"spread_join cannot do a {how} join")
    # At most HOT_KEYS rows, whatever the data: safe to broadcast.
    heavy = F.broadcast(hot_keys(left, key) if hot is None else hot)
    scatter = [F.col(c) for c in (spread_by or left.columns)]
    parts = F.when(F.col(key).isNull(), F.lit(_KEYLESS_SALTS)).otherwise(F.coalesce(SALTS, F.lit(1))).cast("bigint")
    many = left.join(heavy, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*scatter), parts)).drop(SALTS)
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(SALTS, F.lit(1)).cast("bigint") - 1)
    few = right.join(heavy, key, "left").withColumn("_salt", F.explode(copies)).drop(SALTS)
    return many.join(few, [key, "_salt"], how).drop("_salt")

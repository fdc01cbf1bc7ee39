"""Equi-join that splits hot keys over a grid of tasks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affilix.session import materialize

TASK_PAIRS = 4_000_000
MAX_HOT = 10_000


def _bytes(setting: str) -> int:
    """A size setting such as ``10485760b`` or ``64MB`` as a number of bytes."""
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", setting.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit or " ")


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a table's size, the one it compares with the broadcast threshold."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def will_broadcast(df: DataFrame) -> bool:
    """Whether Spark will send this side to every executor, so that nothing is shuffled by key."""
    return estimated_bytes(df) <= _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def hot_keys(left: DataFrame, right: DataFrame, on: list[str], task_pairs: int = TASK_PAIRS) -> DataFrame:
    """Keys whose join would be too much for one task: ``on``, ``_l`` and ``_r`` (rows on either side), ``_cells``.

    A key's load is the number of row pairs it yields. NULL keys join nothing and are not counted.
    """
    def sizes(df: DataFrame, side: int) -> DataFrame:
        one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
        there = df.dropna(subset=on)
        return there.select(*on, (none if side else one).alias("_l"), (one if side else none).alias("_r"))

    load = F.greatest(F.col("_l"), F.lit(1)).cast("double") * F.greatest(F.col("_r"), F.lit(1))
    keys = (
        sizes(left, 0).groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .unionByName(sizes(right, 1).groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r")))
        .groupBy(*on).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
        .withColumn("_load", load)
    )
    return (
        keys.filter(F.col("_load") > task_pairs)
        .withColumn("_cells", F.ceil(F.col("_load") / task_pairs))
        .drop("_load")
    )


def grid_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    *,
    spread_left: list[str],
    spread_right: list[str],
    task_pairs: int = TASK_PAIRS,
    always: bool = False,
) -> DataFrame:
    """Join on equal ``on`` columns (``inner`` or ``left``), every row of a hot key going to one strip of a grid.

    Where one side is small enough for Spark to broadcast, or no key is hot, this is the plain join. Otherwise the left
    rows of a hot key are dealt into strips, the right rows likewise; each pair of strips meets in one task, so a key
    with any share of the rows is worked on by as many tasks as its load asks for. For a left join the left rows are
    dealt out but not repeated. Rows are dealt by a hash of ``spread_*``, which a retried task computes alike.

    The keys of both sides are counted first, so inputs that are costly to compute should be materialized; a side made by
    ``explode`` always, as its estimated size is that of the rows before. The list of hot keys is broadcast while it has
    at most ``MAX_HOT`` rows; a longer one is joined by key. Use this where keys multiply on both sides: where one side
    is unique, the adaptive skew join of Spark does.

    ``always`` is for small sides that yield many pairs: neither is broadcast and no partitions are merged, for either
    would leave the pairs of many small rows to few tasks.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join: {how}")
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def met(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
        if not always:
            return one.join(other, keys, how)
        return one.repartition(parts, *keys).join(other.repartition(parts, *keys).hint("shuffle_hash"), keys, how)

    if not always and (will_broadcast(right) or (how == "inner" and will_broadcast(left))):
        return left.join(right, on, how)
    found = materialize(hot_keys(left, right, on, task_pairs), "hot_keys")
    n_hot = found.count()
    if not n_hot:
        return met(left, right, on)
    cells, n_left, n_right = F.col("_cells"), F.col("_l"), F.greatest(F.col("_r"), F.lit(1))
    if how == "left":
        strips_left, strips_right = cells, F.lit(1).cast("bigint")
    else:
        strips_left = F.least(F.ceil(F.sqrt(cells * F.greatest(n_left, F.lit(1)) / n_right)), cells)
        strips_right = F.ceil(cells / F.greatest(strips_left, F.lit(1)))
    hot = found.select(
        *on,
        F.greatest(strips_left, F.lit(1)).alias("_sl"),
        F.greatest(strips_right, F.lit(1)).alias("_sr"),
    )
    if n_hot <= MAX_HOT:
        hot = F.broadcast(hot)
    one = F.lit(1).cast("bigint")
    sl, sr = F.coalesce("_sl", one), F.coalesce("_sr", one)
    if how == "left":
        # Rows without a key match nothing; deal them out too, or they would all meet in one task.
        no_key = F.lit(False)
        for name in on:
            no_key = no_key | F.col(name).isNull()
        sl_left = F.when(no_key, F.lit(997).cast("bigint")).otherwise(sl)
    else:
        sl_left = sl
    dealt_left = left.join(hot, on, "left").withColumn("_cl", F.pmod(F.xxhash64(*spread_left), sl_left))
    if how == "left":
        dealt_left = dealt_left.withColumn("_cr", F.lit(0).cast("bigint"))
    else:
        dealt_left = dealt_left.withColumn("_cr", F.explode(F.sequence(F.lit(0).cast("bigint"), sr - 1)))
    dealt_right = (
        right.join(hot, on, "left")
        .withColumn("_cr", F.pmod(F.xxhash64(*spread_right), sr))
        .withColumn("_cl", F.explode(F.sequence(F.lit(0).cast("bigint"), sl - 1)))
        .drop("_sl", "_sr")
    )
    return met(dealt_left.drop("_sl", "_sr"), dealt_right, [*on, "_cl", "_cr"]).drop("_cl", "_cr")

"""Sampling, capping and deduplicating rows of a source."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import materialize


def positions(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """df with _pos (0-based, in order within the group, ties as they fall) and _n (rows of the group).

    Ranks come from range-partitioned slices: a slice's rows are ranked in it and moved on by what the slices before it hold, so no
    group has to fit one task.
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    laid = df.repartitionByRange(parts, by, *order).sortWithinPartitions(by, *order)
    # written, because slices of a second run could be cut elsewhere
    laid = materialize(laid.withColumn("_slice", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    ranked = laid.withColumn("_r", F.row_number().over(Window.partitionBy(by, "_slice").orderBy("_row")) - 1)
    sizes = laid.groupBy(by, "_slice").agg(F.count("*").alias("_c"))
    w = Window.partitionBy(by)
    moved = sizes.select(F.col(by).alias("_by"), F.col("_slice").alias("_s"), (F.sum("_c").over(w.orderBy("_slice")) - F.col("_c")).alias("_before"), F.sum("_c").over(w).alias("_n"))
    joined = ranked.join(moved, ranked[by].eqNullSafe(moved["_by"]) & (ranked["_slice"] == moved["_s"]))
    return joined.withColumn("_pos", F.col("_r") + F.col("_before")).drop("_slice", "_row", "_r", "_by", "_s", "_before")


def equidistant(df: DataFrame, cap: int, by: str, order: list[str]) -> DataFrame:
    """At most `cap` rows of each group, at equal distances in the order; all rows of smaller groups. cap 0 keeps everything.

    Of n rows those at floor(i * (n / cap)) are taken, i from 0 to cap - 1, in double precision and in this order.
    """
    if cap <= 0:
        return df
    # few distinct rows a group: the wanted positions are made from the group's size, not looked for in pairs
    p = positions(df, by, order)
    near = F.floor(F.col("_pos") / (F.col("_n") / F.lit(float(cap))))
    step = F.col("_n") / F.lit(float(cap))
    hit = F.lit(False)
    for d in (-1, 0, 1):
        i = near + d
        hit = hit | ((i >= 0) & (i < cap) & (F.floor(i * step) == F.col("_pos")))
    return p.where((F.col("_n") <= cap) | hit).drop("_pos", "_n")


def first_rows(df: DataFrame, cap: int, by: str, order: list[str]) -> DataFrame:
    """The first `cap` rows of each group in the order; cap 0 keeps everything. Spark limits groups before the shuffle."""
    if cap <= 0:
        return df
    w = Window.partitionBy(by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= cap).drop("_rank")


def new_rows(df: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not stored; rows with a null key are never stored ones."""
    return df.join(stored.select(*keys).distinct(), keys, "left_anti")


def one_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key combination in the order. Null keys are a combination of their own.

    Aggregates before the shuffle, so that a key of a third of all rows stays small.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.first(F.lit(1))
    g = df.groupBy(*keys).agg(pick.alias("_x"))
    return g.select(*[F.col(c) if c in keys else F.col("_x").getField(c).alias(c) for c in df.columns])

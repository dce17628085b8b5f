"""Global order without a single-task window.

``Window.orderBy`` with no (or a low-cardinality) partition key sends every
row to one task. Both helpers here split the order into bins that are
monotone in the sort key, compute per-bin totals (a table bounded by the bin
count), turn them into prefix offsets with a window over that small table,
join the offsets back and finish with a window per bin.
The result equals the single-window answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nbsieve.session import cut_lineage


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def rank_by_hash(df: DataFrame, part_cols, hash_col: str, tie_col: str,
                 bucket_chars: int = 4, rank_col: str = "rank",
                 size_col: str = "group_size") -> DataFrame:
    """1-based ``row_number()`` within ``part_cols`` ordered by
    ``(hash_col, tie_col)``, where ``hash_col`` is a hex digest (uniform, so
    its first ``bucket_chars`` characters give 16**bucket_chars bins of equal
    expected size: no hot bin even when one class holds most rows).
    Also adds the group size."""
    part = _cols(part_cols)
    b = "__bucket"
    x = df.withColumn(b, F.substring(F.col(hash_col), 1, bucket_chars))
    counts = x.groupBy(*part, b).agg(F.count(F.lit(1)).alias("__n"))
    w_prev = Window.partitionBy(*part).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(*part)
    offsets = counts.select(
        *part, b,
        F.coalesce(F.sum("__n").over(w_prev), F.lit(0)).alias("__off"),
        F.sum("__n").over(w_all).alias(size_col),
    )
    # Bounded by (#groups x 16**bucket_chars) rows whatever the data size.
    x = x.join(F.broadcast(offsets), part + [b])
    w_in = Window.partitionBy(*part, b).orderBy(F.col(hash_col), F.col(tie_col))
    return x.withColumn(rank_col, (F.col("__off") + F.row_number().over(w_in)).cast("bigint")) \
            .drop(b, "__off")


def running_totals(df: DataFrame, part_cols, order_col: str, value_cols,
                   previous: bool = False) -> DataFrame:
    """Inclusive ascending running sums ``cum_<v>`` of ``value_cols`` over
    ``order_col`` within ``part_cols``, for any values of ``order_col`` that
    are unique per group. With ``previous`` also ``prev_<v>``, the values of the
    row before in that order (NULL for a group's first): within a partition a
    lag, and the last row of every partition is carried to the next one that
    holds the group.

    The rows are range-partitioned by (group, key) and stored, so that every
    partition holds a stretch of the order whatever the values' distribution;
    totals per (group, partition) -- a table of one row per partition and
    group -- give the offsets, and the window sees one stretch."""
    part = _cols(part_cols)
    vals = _cols(value_cols)
    x = cut_lineage(df.repartitionByRange(*part, order_col)
                    .withColumn("__bin", F.spark_partition_id()))
    edge = [F.max_by(F.struct(*vals), order_col).alias("__edge")] if previous else []
    per_bin = x.groupBy(*part, "__bin").agg(*[F.sum(v).alias(v) for v in vals], *edge)
    w_prev = Window.partitionBy(*part).orderBy("__bin") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    offs = per_bin.select(*part, "__bin", *[
        F.coalesce(F.sum(v).over(w_prev), F.lit(0)).alias(f"__off_{v}") for v in vals],
        *([F.lag("__edge").over(Window.partitionBy(*part).orderBy("__bin")).alias("__carry")]
          if previous else []))
    x = x.join(offs, part + ["__bin"])
    w_in = Window.partitionBy(*part, "__bin").orderBy(order_col) \
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for v in vals:
        x = x.withColumn(f"cum_{v}", F.col(f"__off_{v}") + F.sum(v).over(w_in))
        if previous:
            here = Window.partitionBy(*part, "__bin").orderBy(order_col)
            x = x.withColumn(f"prev_{v}", F.coalesce(F.lag(v).over(here), F.col(f"__carry.{v}")))
    return x.drop("__bin", "__carry", *[f"__off_{v}" for v in vals])


def positions(df: DataFrame, order, out: str = "position") -> DataFrame:
    """1-based position of every row in the global ``order`` (a list of
    columns, maybe descending, that leaves no ties): range-partitioned and
    stored, then numbered per partition with offsets from the partitions'
    counts. The distribution of the keys does not matter."""
    x = cut_lineage(df.repartitionByRange(*order).withColumn("__bin", F.spark_partition_id()))
    n = x.groupBy("__bin").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    offs = n.select("__bin", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__off"))
    x = x.join(F.broadcast(offs), "__bin")  # one row per partition
    rank = F.row_number().over(Window.partitionBy("__bin").orderBy(*order))
    return x.withColumn(out, (F.col("__off") + rank).cast("bigint")).drop("__bin", "__off")


def seeded_hash(seed, key: Column | str) -> Column:
    """Deterministic order key: md5('<seed>-<key>'); same value in DuckDB."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}-"), k.cast("string")))

"""Running values over long ordered sequences, split so that no key needs one task.

A plain window partitioned by a recording puts that recording in one task. Here the rows of a
key are cut into blocks by a monotone block expression. The window runs inside a block, the
blocks are reduced to one summary row each, a window over these few summaries gives each block
what came before (or after) it, and a join brings both together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key per block when the order column is a position.
BLOCK = 1 << 16


def position_block(order: str | Column, size: int = BLOCK) -> Column:
    col = F.col(order) if isinstance(order, str) else order
    return F.floor(col / F.lit(size))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    sums: Mapping[str, Column] | None = None,
    sums_before: Mapping[str, Column] | None = None,
    maxes: Mapping[str, Column] | None = None,
    carry: Mapping[str, Column] | None = None,
    lags: Mapping[str, Column] | None = None,
    leads: Mapping[str, Column] | None = None,
    block: Column | None = None,
) -> DataFrame:
    """Add running columns to ``df``; the order must be total inside a key.

    ``sums`` includes the current row and ``sums_before`` stops before it; ``maxes`` is the
    running maximum before the current row; ``carry`` is the last non-null value up to the current
    row; ``lags``/``leads`` are the neighbour's value. ``block`` must not decrease along the order.
    """
    sums, sums_before, maxes = dict(sums or {}), dict(sums_before or {}), dict(maxes or {})
    carry, lags, leads = dict(carry or {}), dict(lags or {}), dict(leads or {})
    block = block if block is not None else position_block(order[0])
    rows = df.withColumn("_blk", block)
    rank = F.struct(*[F.col(c) for c in order])

    local = Window.partitionBy(*keys, "_blk").orderBy(*order)
    upto = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*keys).orderBy("_blk")
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)

    detail, totals, carried, final = [], [], [], {}
    for i, (name, expr) in enumerate(sums.items()):
        detail.append(F.sum(expr).over(upto).alias(f"_s{i}"))
        totals.append(F.sum(expr).alias(f"_ts{i}"))
        carried.append(F.sum(f"_ts{i}").over(earlier).alias(f"_cs{i}"))
        final[name] = F.coalesce(f"_s{i}", F.lit(0)) + F.coalesce(f"_cs{i}", F.lit(0))
    for i, (name, expr) in enumerate(sums_before.items()):
        detail.append(F.sum(expr).over(before).alias(f"_b{i}"))
        totals.append(F.sum(expr).alias(f"_tb{i}"))
        carried.append(F.sum(f"_tb{i}").over(earlier).alias(f"_cb{i}"))
        final[name] = F.coalesce(f"_b{i}", F.lit(0)) + F.coalesce(f"_cb{i}", F.lit(0))
    for i, (name, expr) in enumerate(maxes.items()):
        detail.append(F.max(expr).over(before).alias(f"_m{i}"))
        totals.append(F.max(expr).alias(f"_tm{i}"))
        carried.append(F.max(f"_tm{i}").over(earlier).alias(f"_cm{i}"))
        final[name] = F.greatest(f"_m{i}", f"_cm{i}")
    for i, (name, expr) in enumerate(carry.items()):
        detail.append(F.last(expr, ignorenulls=True).over(upto).alias(f"_l{i}"))
        totals.append(F.max_by(expr, F.when(expr.isNotNull(), rank)).alias(f"_tl{i}"))
        carried.append(F.last(f"_tl{i}", ignorenulls=True).over(earlier).alias(f"_cl{i}"))
        final[name] = F.coalesce(f"_l{i}", f"_cl{i}")
    for i, (name, expr) in enumerate(lags.items()):
        boxed = F.struct(expr.alias("v"))
        detail.append(F.lag(boxed).over(local).alias(f"_g{i}"))
        totals.append(F.max_by(boxed, rank).alias(f"_tg{i}"))
        carried.append(F.lag(f"_tg{i}").over(over).alias(f"_cg{i}"))
        final[name] = F.coalesce(f"_g{i}", f"_cg{i}").getField("v")
    for i, (name, expr) in enumerate(leads.items()):
        boxed = F.struct(expr.alias("v"))
        detail.append(F.lead(boxed).over(local).alias(f"_d{i}"))
        totals.append(F.min_by(boxed, rank).alias(f"_td{i}"))
        carried.append(F.lead(f"_td{i}").over(over).alias(f"_cd{i}"))
        final[name] = F.coalesce(f"_d{i}", f"_cd{i}").getField("v")

    summary = rows.groupBy(*keys, "_blk").agg(*totals).select(*keys, "_blk", *carried)
    body = rows.select("*", *detail)
    joined = body.join(summary, [*keys, "_blk"], "left")
    kept = [c for c in df.columns if c not in final]
    return joined.select(*kept, *[value.alias(name) for name, value in final.items()])


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, name: str = "island",
            block: Column | None = None) -> DataFrame:
    """Number gaps-and-islands groups: a row where ``starts`` holds opens the next island."""
    flag = F.when(starts, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return scan(df, keys, order, sums={name: flag}, block=block)

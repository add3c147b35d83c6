"""Ordered folds with a small carried state, exact and split across tasks.

Some rules (greedy chunking, caption de-duplication, session caps) read a row together with a state
left by all earlier rows. Each key is cut into blocks of consecutive positions. Every block is
first folded from the empty state; then each block whose true entry state (the exit state of the
block before it) differs from the one it was folded with is folded again, until nothing differs.
At that point every block has been folded with its true entry state, so the result equals the
row-by-row fold. Only blocks that differ are read again and no task sees more than a block.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidence_spark.operators.scan import position_block
from evidence_spark.session import cut, spread

FOLD_BLOCK = 4096


def ordered_fold(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    out: T.StructType,
    step: Callable[[pd.DataFrame, object], tuple[pd.DataFrame | list, object]],
    *,
    block: int = FOLD_BLOCK,
    backward: bool = False,
) -> DataFrame:
    """Fold ``step(rows, state) -> (output rows, state)`` along ``order`` inside ``keys``.

    ``order`` is a unique integer position per key. The state must survive JSON. ``backward`` folds from
    the last row to the first. ``step`` may return its rows as lists of values in the order of ``out``, which costs less for short keys.
    """
    keys = list(keys)
    columns = df.columns
    # position blocks bound every group by `block` rows whatever the size of a key
    cells = df.withColumn("_blk", position_block(order, block))
    group = [*keys, "_blk"]
    key_fields = [df.schema[k] for k in keys]
    schema = T.StructType([
        *[T.StructField("_k_" + f.name, f.dataType) for f in key_fields],
        T.StructField("_b", T.LongType()),
        T.StructField("_entry", T.StringType()),
        T.StructField("_exit", T.StringType()),
        T.StructField("_rows", T.ArrayType(out)),
    ])
    names = out.fieldNames()

    def one(pdf: pd.DataFrame) -> dict:
        entry = pdf["_entry"].iloc[0]
        entry = None if entry is None or pd.isna(entry) else entry
        rows = pdf.iloc[::-1] if backward else pdf
        result, state = step(rows[columns].reset_index(drop=True), None if entry is None else json.loads(entry))
        record = {"_k_" + k: pdf[k].iloc[0] for k in keys}
        if isinstance(result, list):
            packed = [dict(zip(names, values)) for values in result]
        else:
            packed = [] if len(result) == 0 else result[names].astype(object).where(result[names].notna(), None).to_dict("records")
        record.update(
            _b=int(pdf["_blk"].iloc[0]), _entry=entry,
            _exit=None if state is None else json.dumps(state, sort_keys=True), _rows=packed,
        )
        return record

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # rows come sorted by group and order; a group that may go on in the next batch is held back
        held = None
        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            cells_of = [g for _, g in part.groupby(group, sort=False, dropna=False)]
            held = cells_of[-1]
            if len(cells_of) > 1:
                yield pd.DataFrame([one(g) for g in cells_of[:-1]], columns=schema.fieldNames())
        if held is not None:
            yield pd.DataFrame([one(held)], columns=schema.fieldNames())

    def fold(rows: DataFrame) -> DataFrame:
        return spread(rows, *group).sortWithinPartitions(*group, order).mapInPandas(run, schema)

    done = cut(fold(cells.withColumn("_entry", F.lit(None).cast("string"))))
    direction = F.col("_b").desc() if backward else F.col("_b")
    over = Window.partitionBy(*["_k_" + k for k in keys]).orderBy(direction)
    while True:
        wanted = done.select(*["_k_" + k for k in keys], "_b", "_entry", F.lag("_exit").over(over).alias("_want"))
        stale = wanted.where(~F.col("_want").eqNullSafe(F.col("_entry")))
        if stale.isEmpty():
            break
        stale = cut(stale.select(*[F.col("_k_" + k).alias(k) for k in keys], F.col("_b").alias("_blk"), F.col("_want").alias("_entry")))
        again = fold(cells.join(stale, group))
        mark = stale.select(*[F.col(k).alias("_k_" + k) for k in keys], F.col("_blk").alias("_b"))
        keep = done.join(mark, [*["_k_" + k for k in keys], "_b"], "left_anti")
        done = cut(keep.unionByName(again))
    return done.select(F.inline("_rows"))

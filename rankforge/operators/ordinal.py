"""Distributed positions: global or per-group row numbers without a
single-partition window (W1, W3, M4, O3 all build on it).

``row_number() over (order by k)`` moves every row into one task, and
``row_number() over (partition by g order by k)`` moves a whole group into
one task -- a hot group holding a third of the rows would then sit in one
task. Here the rows are range-partitioned on ``(group, order)`` instead, so a
hot group is spread over many partitions, and each row's position is
``rows before it in earlier partitions + its position inside its partition``.
The per-partition counts form a table of at most ``partitions + groups - 1``
rows; AQE broadcasts it where it is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.session import ensure_checkpoint_dir

_PID, _POS = "_rf_pid", "_rf_pos"


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def with_ordinal(
    df: DataFrame,
    order_by: Sequence,
    group_by: Sequence[str] = (),
    name: str = "ordinal",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of the row in ``order_by`` order,
    restarting at 1 for every ``group_by`` value.

    ``order_by`` (with ``group_by``) should be unique -- append a key -- so
    that the numbering is reproducible. The range-partitioned, sorted frame is
    checkpointed to the session's reliable checkpoint directory: both passes
    (counts and numbering) then read the same bytes, even after an executor
    loss. Project the frame to the columns you need before calling.
    One plan at every size: without ``num_partitions`` the range exchange has
    the session's shuffle partitions, which AQE merges by bytes.
    """
    group_by = list(group_by)
    ensure_checkpoint_dir(df.sparkSession)
    keys = _cols(group_by) + _cols(order_by)

    ranged = (
        (df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys))
        .sortWithinPartitions(*keys)
        .withColumn(_PID, F.spark_partition_id())
        .withColumn(_POS, F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    cells = ranged.groupBy(_PID, *group_by).agg(
        F.min(_POS).alias("_rf_first"), F.count(F.lit(1)).alias("_rf_n")
    )
    before = Window.partitionBy(*group_by).orderBy(_PID).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # Offsets get fresh column names: joining a frame with an aggregate of
    # itself must not leave ambiguous column references.
    gnames = [f"_rf_g{i}" for i in range(len(group_by))]
    offsets = cells.select(
        F.col(_PID).alias("_rf_opid"),
        *[F.col(g).alias(a) for g, a in zip(group_by, gnames)],
        "_rf_first",
        F.coalesce(F.sum("_rf_n").over(before), F.lit(0)).alias("_rf_before"),
    )
    cond = [F.col(_PID) == F.col("_rf_opid")] + [
        F.col(g).eqNullSafe(F.col(a)) for g, a in zip(group_by, gnames)
    ]
    position = F.col("_rf_before") + (F.col(_POS) - F.col("_rf_first")) + F.lit(1)
    return ranged.join(offsets, cond, "inner").select(*df.columns, position.alias(name))


def with_chunk_id(
    df: DataFrame,
    order_by: Sequence,
    size: int,
    name: str = "chunk_id",
    group_by: Sequence[str] = (),
) -> DataFrame:
    """``chunk = floor((position - 1) / size)``: rows [0, size) -> 0, ...

    Used for shards of 1,000 rows (S11) and lookup batches of 100 (C11).
    """
    with_pos = with_ordinal(df, order_by, group_by, name="_rf_chunk_pos")
    return with_pos.withColumn(
        name, F.floor((F.col("_rf_chunk_pos") - 1) / F.lit(size)).cast("bigint")
    ).drop("_rf_chunk_pos")

"""Load only what is new since the last run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.joins import not_in
from starloom.sources.readers import incremental_read, mark_literal, mark_value, stamp_batch
from starloom.sources.sinks import append, replace_table
from starloom.streaming.marks import DEFAULT_MARK, empty_marks, get_mark, upsert_mark


def incremental_load(
    source: DataFrame,
    table: str,
    marks_table: str,
    *,
    mark_col: str,
    columns: Sequence[str],
    batch_ts: datetime,
    default: Any = DEFAULT_MARK,
    lookback: timedelta | None = None,
    key: Sequence[str] | None = None,
    partition_by: Sequence[str] = (),
    held: DataFrame | None = None,
    write: Callable[..., object] = append,
) -> bool:
    """Append the rows of ``source`` above the mark and move the mark.

    The upper end of the batch is fixed before it is written, so rows arriving
    meanwhile wait for the next run.  Without new rows nothing is touched and
    False is returned.  ``key`` makes a repeated or reached-back load skip rows
    the table already holds, NULLs being equal; a load that failed before its
    mark moved is repeated without harm.  Late rows do not move a mark back.
    ``partition_by`` is the layout of a table that does not exist yet.  ``held``
    are the table's rows that may meet the batch; all of them if not given.
    ``write`` takes the batch, the table and that layout.
    """
    spark = source.sparkSession
    known = spark.catalog.tableExists(marks_table)
    marks = spark.table(marks_table) if known else empty_marks(spark)
    last = get_mark(marks, table, default)
    batch = incremental_read(source, mark_col, last, columns, lookback=lookback)
    if key and spark.catalog.tableExists(table):
        held = spark.table(table) if held is None else held
        if lookback is not None:  # older rows cannot meet the batch
            reach = mark_literal(held, mark_col, last) - F.expr(
                f"make_dt_interval(0, 0, 0, {lookback.total_seconds()})"
            )
            held = held.where(mark_value(held, mark_col) > reach)
        batch = not_in(batch, held, key, null_safe=True)
    value = mark_value(batch, mark_col)
    upper = batch.agg(F.max(value).alias("top"), F.max(value).cast("timestamp").alias("mark")).first()
    if upper["top"] is None:
        return False
    batch = batch.where(value <= mark_literal(batch, mark_col, upper["top"]))
    write(stamp_batch(batch, batch_ts), table, partition_by)
    before = get_mark(marks, table, None)
    mark = upper["mark"] if before is None else max(before, upper["mark"])
    moved = spark.createDataFrame([(table, mark, batch_ts)], marks.schema)
    replace_table(upsert_mark(marks, moved), marks_table)
    return True

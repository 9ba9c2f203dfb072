"""How a table's rows lie in files: clustering by several columns, and compaction."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.sources.sinks import replace_snapshot, table_files

#: Bits of a column's approximate rank, and the error of its borders.
RANK_BITS = 8
_ERROR = 1e-3
#: Rows that a task sorts into one file, by which large tables get more files.
FILE_ROWS = 1_000_000


def _number(df: DataFrame, name: str) -> Column:
    """A column's values as numbers in the same order; texts by their first six bytes."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substr(c.cast("binary"), F.lit(1), F.lit(6))), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _rank(value: Column, borders: Sequence[float]) -> Column:
    """How many of the ascending borders a value reaches, by halving; NULL: none."""
    listed = F.array(*[F.lit(float(b)) for b in borders])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(RANK_BITS))])
    return F.aggregate(
        halves,
        F.lit(0),
        lambda r, step: F.when(F.coalesce(value >= F.get(listed, r + step - 1), F.lit(False)), r + step).otherwise(r),
    )


def clustered(df: DataFrame, columns: Sequence[str], files: int) -> DataFrame:
    """``df`` dealt and sorted so that each file spans little of every one of ``columns``.

    There are ``files`` files, or more where one would get over ``FILE_ROWS`` rows: a
    task sorts a file's rows, so what it holds does not grow with the table.

    Each column's approximate rank (``RANK_BITS`` bits, by quantiles: one pass for
    all, some hundred numbers to the driver) gives its bits in turn to one number,
    by which rows are range-partitioned: a filter on any of the columns then skips
    files by their least and largest values. Columns are numbers, dates, timestamps
    or texts. NULLs lie with the least values; no row is changed, lost or added.
    """
    files = max(files, -(-df.count() // FILE_ROWS))
    numbers = df.select(*[_number(df, c).alias(c) for c in columns])
    shares = [k / (1 << RANK_BITS) for k in range(1, 1 << RANK_BITS)]
    borders = numbers.approxQuantile(list(columns), shares, _ERROR)
    ranks = [_rank(_number(df, c), b) if b else F.lit(0) for c, b in zip(columns, borders)]
    ranked = df.withColumns({f"_rank{j}": r for j, r in enumerate(ranks)})
    place = F.lit(0).cast("bigint")
    for k in range(RANK_BITS):
        for j in range(len(columns)):
            bit = F.shiftright(f"_rank{j}", k).bitwiseAND(F.lit(1)).cast("bigint")
            place = place.bitwiseOR(F.shiftleft(bit, k * len(columns) + j))
    placed = ranked.withColumn("_place", place).drop(*[f"_rank{j}" for j in range(len(columns))])
    return placed.repartitionByRange(files, "_place").sortWithinPartitions("_place", *columns).drop("_place")


def bins(sizes: Iterable[tuple[str, int]], target: int) -> list[list[str]]:
    """Files packed into bins of at most ``target`` bytes, the largest first, each into
    the first bin that has room. A larger file has a bin of its own."""
    out: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        for k, (held, names) in enumerate(out):
            if held + size <= target:
                out[k] = (held + size, [*names, name])
                break
        else:
            out.append((size, [name]))
    return [names for _, names in out]


#: Local files are spelt ``file:/x`` by listings and ``file:///x`` by scans.
_SCHEME = ("^file:/+", "/")


def _plain(name: str) -> str:
    return re.sub(*_SCHEME, name)


def compact(spark: SparkSession, table: str, target: int = 128 << 20) -> tuple[int, int]:
    """Merge the small files of each partition; tells how many files were and are.

    Only partitions that come out with at most half their files are written anew,
    all in one job in which a task makes one file; then the table points at them.
    Until then readers see the old files, and a run that broke off leaves nothing
    but a folder that ``vacuum`` removes. Sizes come from the file listing.
    """
    listed = table_files(spark, table)
    plan, kept, before, after = [], [], 0, 0
    for spec, files in listed.items():
        packed = bins(files, target)
        before += len(files)
        if 2 * len(packed) <= len(files):
            plan += [(spec, names) for names in packed]
            after += len(packed)
        else:
            kept += [(_plain(name), -1) for name, _ in files]
            after += len(files)
    if not plan:
        return before, before
    known = spark.createDataFrame(
        [(_plain(name), k) for k, (_, names) in enumerate(plan) for name in names] + kept, "_file string, _bin int"
    )
    path = F.regexp_replace(F.col("_metadata.file_path"), *_SCHEME)
    rows = spark.table(table).withColumn("_path", path)
    # A row per listed file: the driver holds them already.
    binned = rows.join(F.broadcast(known), F.col("_path") == F.col("_file"), "left")
    # A file that appeared after the listing must not be lost.
    sure = F.coalesce("_bin", F.raise_error(F.lit("a file came in during compaction")).cast("int"))
    binned = binned.withColumn("_bin", sure).where("_bin >= 0").drop("_path", "_file")
    dealt = binned.repartitionById(len(plan), F.col("_bin")).drop("_bin")
    replace_snapshot(dealt, table, {spec for spec, _ in plan})
    return before, after

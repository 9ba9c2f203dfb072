"""Sinks on plain parquet tables.

A table is external and points at a snapshot folder.  Replacing it writes a
new snapshot first and then moves the pointer, so a job may read the table it
replaces and a failed write leaves the old state in place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timedelta
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Characters Spark writes as %XX in partition folder names.
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(i) for i in range(1, 32)}


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _folder(value: str | None) -> str:
    if value is None or value == "":
        return _NO_VALUE
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


#: Partitions that a task writes side by side; it sorts only the rows of others.
_OPEN_FILES = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes in which tasks do not sort their rows by partition first.

    Rows come dealt by partition or are a batch of one, so a task has few partitions;
    a sort would hold all its rows. A session's own setting is left as it is.
    """
    if int(spark.conf.get(_WRITERS, "0")) > 0:
        yield
        return
    spark.conf.set(_WRITERS, str(_OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.unset(_WRITERS)


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _snapshot_path(spark: SparkSession, table: str) -> str:
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    full = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
    return f"{root}/_snapshots/{full}/{uuid4().hex}"


def _columns_ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _create(
    spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str], path: str
) -> None:
    spread = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE {table} ({_columns_ddl(schema)}) USING parquet{spread} LOCATION '{path}'"
    )
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def ensure_table(
    spark: SparkSession, table: str, schema: T.StructType | str, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty typed table unless it exists."""
    if spark.catalog.tableExists(table):
        return
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    path = _snapshot_path(spark, table)
    plain = T.StructType([f for f in schema.fields if f.name not in partition_by])
    spark.createDataFrame([], plain).write.parquet(path)
    _create(spark, table, schema, partition_by, path)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Make ``df`` the table's whole content; ``df`` may read the table itself.

    Rows are rebalanced by partition value before a partitioned write: few
    files per value, and AQE splits a value that holds much of the data.
    """
    spark = df.sparkSession
    path = _snapshot_path(spark, table)
    # Column metadata and nullability stay out of the catalog.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    if partition_by:
        with _unsorted(spark):
            df.hint("rebalance", *[F.col(c) for c in partition_by]).write.partitionBy(
                *partition_by
            ).parquet(path)
    else:
        df.write.parquet(path)
    if spark.catalog.tableExists(table):
        same = spark.table(table).schema.simpleString() == schema.simpleString()
        if same and list(partition_by) == partition_columns(spark, table):
            if partition_by:
                _swap(spark, table, path, schema, _specs(spark, table))
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        # Another layout: the entry is made anew; files of an external table stay.
        spark.sql(f"DROP TABLE {table}")
    _create(spark, table, schema, partition_by, path)


Spec = tuple[str | None, ...]


def _spec(keys: Sequence[str], row: Spec) -> str:
    """A partition as SQL names it."""
    return ", ".join(f"`{k}` = " + ("NULL" if v is None else _literal(v)) for k, v in zip(keys, row))


def _values(frame: DataFrame, keys: Sequence[str]) -> set[Spec]:
    """One entry per partition; for files, answered from folder names."""
    names = [F.col(k).cast("string").alias(k) for k in keys]
    return {tuple(r) for r in frame.select(*names).distinct().collect()}


def _specs(spark: SparkSession, table: str) -> set[Spec]:
    """The partitions in a table's catalog entry, empty ones too."""
    found = set()
    for (name,) in spark.sql(f"SHOW PARTITIONS {table}").collect():
        parts = [unquote(p.split("=", 1)[1]) for p in name.split("/")]
        found.add(tuple(None if p == _NO_VALUE else p for p in parts))
    return found


#: Partitions that one statement adds or drops.
_AT_ONCE = 500


def partition_values(spark: SparkSession, table: str) -> list[str | None]:
    """The values of a table's one partition column as text, from the catalog alone."""
    return sorted((spec[0] for spec in _specs(spark, table)), key=str)


def _swap(
    spark: SparkSession, table: str, path: str, schema: T.StructType, touched: set[Spec]
) -> None:
    """Point partitions at the snapshot ``path``: its own, then drop others ``touched``.

    Adding goes first: a reader may meanwhile see a moved row twice, never not at
    all, and a swap that is broken off is completed by the next one.
    """
    keys = partition_columns(spark, table)
    written = sorted(_values(spark.read.schema(schema).parquet(path), keys), key=str)
    known = _specs(spark, table)

    def spec(row: Spec) -> str:
        return f"PARTITION ({_spec(keys, row)})"

    def place(row: Spec) -> str:
        folder = "/".join(f"{k}={_folder(v)}" for k, v in zip(keys, row))
        return "LOCATION " + _literal(f"{path}/{folder}")

    def several(command: str, parts: list[str], sep: str) -> None:
        for k in range(0, len(parts), _AT_ONCE):
            spark.sql(f"ALTER TABLE {table} {command} {sep.join(parts[k : k + _AT_ONCE])}")

    several("ADD IF NOT EXISTS", [f"{spec(r)} {place(r)}" for r in written if r not in known], " ")
    for row in written:
        if row in known:
            spark.sql(f"ALTER TABLE {table} {spec(row)} SET {place(row)}")
    gone = sorted(touched - set(written), key=str)
    several("DROP IF EXISTS", [spec(row) for row in gone], ", ")
    spark.catalog.refreshTable(table)


def replace_partitions(df: DataFrame, table: str, touched: DataFrame | None = None) -> None:
    """Replace some partitions of a table and leave the others as they are.

    These are the partitions ``df`` holds rows of, and any further ones listed
    in ``touched`` (distinct partition values), which end up empty.
    """
    spark = df.sparkSession
    keys = partition_columns(spark, table)
    if not keys:
        raise ValueError(f"{table} is not partitioned")
    schema = spark.table(table).schema
    path = _snapshot_path(spark, table)
    with _unsorted(spark):
        df.select(*schema.names).hint("rebalance", *[F.col(k) for k in keys]).write.partitionBy(
            *keys
        ).parquet(path)
    _swap(spark, table, path, schema, _values(touched, keys) if touched is not None else set())


def replace_snapshot(df: DataFrame, table: str, specs: set[Spec]) -> None:
    """Write the rows of whole partitions ``specs`` anew as ``df`` deals them, and point at them.

    For a table without partitions, whose one spec is empty, ``df`` is all of it.
    """
    spark = df.sparkSession
    keys = partition_columns(spark, table)
    schema = spark.table(table).schema
    path = _snapshot_path(spark, table)
    writer = df.select(*schema.names).write
    if keys:
        with _unsorted(spark):
            writer.partitionBy(*keys).parquet(path)
        _swap(spark, table, path, schema, specs)
    else:
        writer.parquet(path)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)


def table_files(spark: SparkSession, table: str) -> dict[Spec, list[tuple[str, int]]]:
    """Path and size of the data files of each partition, from the file system's listing."""
    keys = partition_columns(spark, table)
    out: dict[Spec, list[tuple[str, int]]] = {}
    for row in sorted(_specs(spark, table), key=str) if keys else [()]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_location(spark, table, _spec(keys, row) if keys else None))
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [
            (f.getPath().toUri().toString(), f.getLen())
            for f in (files.listStatus(folder) if files.exists(folder) else ())
            if f.isFile() and not f.getPath().getName().startswith(("_", "."))
        ]
        if found:
            out[row] = found
    return out


def _location(spark: SparkSession, table: str, spec: str | None = None) -> str:
    where = f" PARTITION ({spec})" if spec else ""
    told = spark.sql(f"DESCRIBE EXTENDED {table}{where}")
    return told.where("lower(col_name) = 'location'").first()["data_type"]


def vacuum(spark: SparkSession, table: str, older_than: timedelta = timedelta(0)) -> int:
    """Delete the snapshots of a table that neither it nor a partition points at;
    tells how many.  Give ``older_than`` where others may be reading or writing it.
    """
    root = _snapshot_path(spark, table).rsplit("/", 1)[0]
    keys = partition_columns(spark, table)
    live = {_location(spark, table)}
    live |= {_location(spark, table, _spec(keys, row)) for row in (_specs(spark, table) if keys else ())}
    named = {part for place in live for part in place.split("/")}
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    before = (datetime.now() - older_than).timestamp() * 1000
    gone = 0
    for entry in files.listStatus(folder) if files.exists(folder) else ():
        if entry.getPath().getName() not in named and entry.getModificationTime() <= before:
            gone += bool(files.delete(entry.getPath(), True))
    return gone


def insert_into(df: DataFrame, table: str) -> None:
    """Append by column name; the columns must be exactly the table's."""
    names = df.sparkSession.table(table).columns
    if sorted(names) != sorted(df.columns):
        raise ValueError(f"columns {df.columns} do not match {table} {names}")
    with _unsorted(df.sparkSession):
        df.select(*names).write.insertInto(table)


def append(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows, creating the table on first use."""
    ensure_table(df.sparkSession, table, df.schema, partition_by)
    insert_into(df, table)


def ctas_if_absent(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> bool:
    """Create the table from ``df`` unless it exists; tells whether it did."""
    if df.sparkSession.catalog.tableExists(table):
        return False
    replace_table(df, table, partition_by)
    return True


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL, replacing an earlier view of that name."""
    df.createOrReplaceTempView(name)
    return df

"""Keyed, versioned feature tables on Parquet."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce
from urllib.parse import unquote

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.operators.clean import describe_columns
from aerolith.operators.merge import keep_first
from aerolith.operators.quality import require_minima
from aerolith.schemas import FEATURE_TABLES, TableSpec
from aerolith.sources.tables import PERIOD, filesystem, read_stored, table_exists, table_path

READY = "_READY"


def _laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the period column and gather each directory's rows.

    ``rebalance`` lets AQE split a directory that holds most of the rows over several tasks
    and merge small ones, so a dominant region is never written by a single task.
    """
    dated = df.withColumn(PERIOD, F.date_format(spec.event_time, spec.period))
    return dated.hint("rebalance", *spec.partition_by, PERIOD)


def _stage(df: DataFrame, spec: TableSpec, path: str) -> str:
    """Write the new contents of the touched folders beside the table; readers skip names with an underscore."""
    staged = f"{path}/_stage-{uuid.uuid4().hex}"
    rows = _laid_out(describe_columns(df, spec.comments), spec)
    rows.write.partitionBy(*spec.partition_by, PERIOD).parquet(staged)
    return staged


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative paths of the partition folders below ``path``."""
    fs, top = filesystem(spark, path)
    found = [""]
    for _ in range(depth):
        deeper = []
        for folder in found:
            _, here = filesystem(spark, f"{path}/{folder}".rstrip("/"))
            names = [s.getPath().getName() for s in fs.listStatus(here) if s.isDirectory()] if fs.exists(here) else []
            deeper += [f"{folder}/{n}".lstrip("/") for n in names if "=" in n]
        found = deeper
    return found


def _swap(spark: SparkSession, path: str, staged: str, depth: int) -> None:
    """Put the staged folders in the place of the live ones.  May be repeated after a crash at any point."""
    fs, stage = filesystem(spark, staged)
    for folder in _folders(spark, staged, depth):
        _, new = filesystem(spark, f"{staged}/{folder}")
        _, live = filesystem(spark, f"{path}/{folder}")
        fs.delete(live, True)
        fs.mkdirs(live.getParent())
        if not fs.rename(new, live):
            raise OSError(f"can't move {new} to {live}")
    gone = _read_gone(spark, staged)
    for folder in gone:
        fs.delete(filesystem(spark, f"{path}/{folder}")[1], True)
    fs.delete(stage, True)


def _read_gone(spark: SparkSession, staged: str) -> list[str]:
    return [row.value for row in spark.read.text(f"{staged}/{READY}").collect() if row.value]


def finish_swaps(spark: SparkSession, spec: TableSpec, root: str) -> None:
    """Complete an upsert that was cut off while it swapped folders; forget one that never got ready."""
    path = table_path(root, spec.name, spec.version)
    fs, top = filesystem(spark, path)
    if not fs.exists(top):
        return
    for status in fs.listStatus(top):
        name = status.getPath().getName()
        if name.startswith("_stage-"):
            staged = f"{path}/{name}"
            if fs.exists(filesystem(spark, f"{staged}/{READY}/_SUCCESS")[1]):
                _swap(spark, path, staged, len(spec.partition_by) + 1)
            else:
                fs.delete(status.getPath(), True)


def _replace(df: DataFrame, spec: TableSpec, root: str, touched: list[str]) -> None:
    """Staged replacement of the folders that ``df`` fills, and of those in ``touched`` that it leaves empty."""
    spark, path = df.sparkSession, table_path(root, spec.name, spec.version)
    staged = _stage(df, spec, path)
    filled = _folders(spark, staged, len(spec.partition_by) + 1)
    gone = sorted(set(touched) - set(filled))
    # The folder of the decision is written last; once it is complete the swap will be finished.
    spark.createDataFrame([(g,) for g in gone] or [("",)], "value string").coalesce(1).write.text(f"{staged}/{READY}")
    _swap(spark, path, staged, len(spec.partition_by) + 1)
    spark.catalog.refreshByPath(path)


def create_table(df: DataFrame, spec: TableSpec, root: str) -> None:
    """Store the first contents of a table; a stored one of that version must not exist."""
    if table_exists(df.sparkSession, root, spec.name, spec.version):
        raise FileExistsError(f"{spec.name} version {spec.version} is stored already")
    _replace(df, spec, root, [])


def _same(left: str, right: str, columns: Sequence[str]) -> Column:
    """Equal in all columns; NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def upsert(
    df: DataFrame, spec: TableSpec, root: str, order: Sequence[str] = (), expectations=(), remove: DataFrame | None = None
) -> bool:
    """Insert rows, replacing stored rows of equal key.  False if there was nothing to do.

    Keys may hold NULL, which is a key like any other.  Only directories (region, period) that
    the batch touches are read and rewritten: aside first, then swapped in by renaming, which a
    later upsert completes if it was cut off.  A batch sent twice changes nothing.
    ``order`` decides which of several batch rows of one key stays (descending); without it, or
    where it ties, the row that is greatest in its other columns.  ``remove`` holds keys whose
    stored rows go if the batch has none for them.
    """
    spark = df.sparkSession
    finish_swaps(spark, spec, root)
    descending = [F.col(c).desc() for c in [*order, *(c for c in df.columns if c not in order and c not in spec.keys)]]
    batch = keep_first(df, spec.keys, descending or [F.col(k) for k in spec.keys]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        keys = batch.select(*spec.keys)
        if remove is not None:
            keys = keys.unionByName(remove.select(*spec.keys)).distinct()
        if keys.isEmpty():
            return False
        if expectations:
            require_minima(batch, expectations)
        if not table_exists(spark, root, spec.name, spec.version):
            if batch.isEmpty():
                return False
            _replace(batch, spec, root, [])
            return True
        parts = [*spec.partition_by, PERIOD]
        periods = keys.withColumn(PERIOD, F.date_format(spec.event_time, spec.period))
        touched = periods.select(*parts).distinct().persist(StorageLevel.MEMORY_AND_DISK)
        first, last = touched.agg(F.min(PERIOD), F.max(PERIOD)).first()
        stored = read_stored(spark, root, spec.name, spec.version)
        kept = (
            # A literal range of periods prunes the file listing; the semi join settles the rest.
            stored.filter(F.col(PERIOD).between(first, last) | F.col(PERIOD).isNull()).alias("s")
            .join(touched.alias("t"), _same("s", "t", parts), "left_semi")
            .join(keys.alias("k"), _same("s", "k", spec.keys), "left_anti")
            .drop(PERIOD)
        )
        folders = []
        if remove is not None:
            # Only removal can empty a folder; the touched ones are few: those of the batch.
            existing = _folders(spark, table_path(root, spec.name, spec.version), len(parts))
            names = {tuple("null" if v is None else str(v) for v in row) for row in touched.collect()}
            folders = [f for f in existing if tuple(_value(p) for p in f.split("/")) in names]
        _replace(batch.unionByName(kept, allowMissingColumns=True), spec, root, folders)
        touched.unpersist()
        return True
    finally:
        batch.unpersist()


def _value(folder: str) -> str:
    value = unquote(folder.split("=", 1)[1])
    return "null" if value == "__HIVE_DEFAULT_PARTITION__" else value


def upsert_all(tables: Mapping[str, DataFrame], root: str, version: int | None = None) -> dict[str, bool]:
    """Upsert several tables by name; empty ones are skipped, the first failure stops."""
    done = {}
    for name, df in tables.items():
        spec = FEATURE_TABLES[name]
        if version is not None:
            spec = replace(spec, version=version)
        done[name] = upsert(df, spec, root)
    return done

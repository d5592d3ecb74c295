"""Sinks: create-table-as-select, insert-select, and the shared tables of the business schemas.

A business relation that costs a join or an aggregate can be written once by
``prepare`` and is then read by every query.  Queries never write: without
an up-to-date copy they derive the relation as part of their own plan.  A copy
is up to date while the source tables have the modification time and length
that it was derived from; callers put a version of their deriving code in its
name.  Copies lie under the session's checkpoint folder (``spark.checkpoint.dir``, a
shared folder on a cluster).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from .paths import hadoop_path
from .store import StoredTable

# Session conf switch: "false" computes every binding on the fly, prepared or not.
MATERIALISE_CONF = "tillroll.materialise"
# Session conf: sub-folder of the shared tables (e.g. one per benchmark run).
NAMESPACE_CONF = "tillroll.tables.namespace"


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """``CREATE TABLE AS`` (``mode='overwrite'``) or a plain ``INSERT ... SELECT``
    (``mode='append'``) into a Parquet table at ``path``; see ``store`` for inserts that may be repeated."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _fingerprint(spark: SparkSession, sources: Sequence[str]) -> str:
    """Identity of the source tables: path, length and modification time (one status call each)."""
    h = hashlib.sha256()
    for src in sources:
        fs, p = hadoop_path(spark, src)
        status = fs.getFileStatus(p)
        h.update(f"{src}|{status.getLen()}|{status.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def _place(spark: SparkSession, name: str, sources: Sequence[str], base: str) -> StoredTable:
    space = spark.conf.get(NAMESPACE_CONF, "shared")
    of = hashlib.sha256("|".join(sources).encode()).hexdigest()[:12]
    return StoredTable(spark, f"{base.rstrip('/')}/tillroll-tables/{space}/{name}-{of}")


def materialised(spark: SparkSession, name: str, sources: Sequence[str],
                 build: Callable[[], DataFrame]) -> DataFrame:
    """The prepared copy of ``name`` if there is one for these ``sources``, else ``build()``."""
    if spark.conf.get(MATERIALISE_CONF, "true").lower() == "false":
        return build()
    base = checkpoint_dir(spark, required=False)
    if base is None:
        return build()
    t = _place(spark, name, sources, base)
    if t.exists():
        m = t.manifest()
        if m.writes == [_fingerprint(spark, sources)]:
            return t.rows_of(m)
    return build()


def prepare(spark: SparkSession, name: str, sources: Sequence[str], build: Callable[[], DataFrame]) -> bool:
    """Write the copy of ``name`` that ``materialised`` reads: whether there was something to do."""
    base = checkpoint_dir(spark)
    t = _place(spark, name, sources, base)
    now, rows = _fingerprint(spark, sources), build()
    StoredTable.create(spark, t.path, rows.schema, if_not_exists=True)
    done = t.replace(rows, now)
    t.vacuum()   # copies of earlier sources, once nobody can still be reading them
    return done

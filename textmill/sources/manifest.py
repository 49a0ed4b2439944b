"""Exports that become visible as a whole.

Each sink writes to a folder of its own attempt, ``<out>/<sink>/<attempt>``.  When
it is complete a row of the progress table names it; when all sinks of an export
are complete, the rows of one manifest, written last, make them visible together.
Readers ask ``visible`` and never list folders, so a killed run leaves data
nobody reads, and no half export.  A rerun under the same ``export_id`` goes on
after the last complete sink.

Both tables are JSON files that Spark writes and commits; nothing is renamed, so
this holds in stores without atomic renames too."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ROW = "export_id string, sink string, path string, rows long, at double"


def _rows(spark: SparkSession, path: str) -> list:
    """Rows of a small table, none if it was never written (a row a sink and export)."""
    try:
        return spark.read.schema(ROW).json(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").json(path)


class Export:
    """One export below ``out``."""

    def __init__(self, spark: SparkSession, out: str, export_id: str | None = None) -> None:
        self.spark, self.out, self.export_id = spark, out.rstrip("/"), export_id or uuid.uuid4().hex
        done = [r for r in _rows(spark, f"{self.out}/_progress") if r.export_id == self.export_id]
        self.done = {r.sink: (r.path, r.rows) for r in sorted(done, key=lambda r: r.at)}

    def sink(self, name: str, write: Callable[[str], int | None]) -> str:
        """The sink's folder: written now, unless an earlier attempt completed it.
        ``write(path)`` writes and may return the number of rows."""
        if name not in self.done:
            path = f"{self.out}/{name}/{uuid.uuid4().hex}"
            rows = write(path)
            _append(self.spark, f"{self.out}/_progress", [(self.export_id, name, path, rows, time.time())])
            self.done[name] = (path, rows)
        return self.done[name][0]

    def commit(self) -> None:
        """Make the sinks visible, instead of those of earlier exports."""
        now = time.time()
        _append(self.spark, f"{self.out}/_manifest", [(self.export_id, k, p, n, now) for k, (p, n) in sorted(self.done.items())])


def visible(spark: SparkSession, out: str) -> dict[str, str]:
    """Folder by sink of the last export that was completed."""
    rows = _rows(spark, f"{out.rstrip('/')}/_manifest")
    last = max((r.at for r in rows), default=None)
    return {r.sink: r.path for r in rows if r.at == last}


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """All committed exports, a row a sink."""
    return spark.createDataFrame([tuple(r) for r in _rows(spark, f"{out.rstrip('/')}/_manifest")], ROW)

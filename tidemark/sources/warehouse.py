"""Warehouse folder: run-partitioned logs, and tables replaced part by part.

A replaced table keeps each part (a date, a key bucket) in the folder of the run that wrote it.
Which run is live for which part, and every high-water mark, is one small file per published run,
named by its number; writing that file publishes all of the run's tables and its mark together. A
run that dies before it leaves the last published state as it was, and of two runs that started from
the same state only the first to publish does so.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import freed_shuffles
from tidemark.sources.files import append_run

PART = "part"
# Publications kept besides the newest one.
KEPT = 20


class Conflict(RuntimeError):
    """Another run has published since the state was read."""


@dataclass(frozen=True)
class State:
    """Live run per (table, part), mark per pipeline and buckets per table, as published or about to be."""

    seq: int = 0
    live: dict[tuple[str, str], str] = field(default_factory=dict)
    marks: dict[str, datetime] = field(default_factory=dict)
    buckets: dict[str, int] = field(default_factory=dict)
    repeated: bool = False

    def parts(self, table: str) -> set[str]:
        return {part for name, part in self.live if name == table}

    def replaced(self, table: str, taken: Iterable[str], written: Iterable[str], run_id: str) -> State:
        """Drop the `taken` parts of a table and add the ones a run wrote."""
        gone = {(table, part) for part in taken}
        live = {name: run for name, run in self.live.items() if name not in gone}
        return replace(self, live=live | {(table, part): run_id for part in written})

    def bucketed(self, table: str, buckets: int) -> State:
        return replace(self, buckets=self.buckets | {table: buckets})

    def marked(self, pipeline: str, mark: datetime) -> State:
        return replace(self, marks=self.marks | {pipeline: mark})


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _files(self) -> tuple:
        """Hadoop's file system of the root, and its path class."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return path(self.root).getFileSystem(conf), path

    def _names(self, folder: str) -> list[str]:
        files, path = self._files()
        found = path(self.path(folder))
        return sorted(f.getPath().getName() for f in files.listStatus(found)) if files.exists(found) else []

    def _publications(self) -> list[str]:
        return [name for name in self._names("_published") if name.endswith(".json") and not name.startswith(".")]

    def _marker(self, run_id: str) -> str:
        return self.path(f"_published/runs/{quote(run_id, safe='')}")

    def _newest(self) -> dict | None:
        names = self._publications()
        if not names:
            return None
        files, path = self._files()
        stream = files.open(path(self.path(f"_published/{names[-1]}")))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self, run_id: str | None = None) -> State:
        """Read the newest publication: one entry per live part, bounded by dates and buckets.

        `repeated` tells whether `run_id` has been published already.
        """
        newest = self._newest()
        if newest is None:
            return State()
        files, path = self._files()
        repeated = run_id is not None and (newest["run_id"] == run_id or files.exists(path(self._marker(run_id))))
        live = {(name, part): run for name, part, run in newest["live"]}
        marks = {name: datetime.fromisoformat(mark) for name, mark in newest["marks"].items()}
        return State(newest["seq"], live, marks, newest["buckets"], repeated)

    def publish(self, state: State, run_id: str) -> State:
        """Make a state the newest one; Conflict if it is not the successor of the newest any more."""
        after = replace(state, seq=state.seq + 1)
        text = json.dumps(
            {
                "seq": after.seq,
                "run_id": run_id,
                "live": [[name, part, run] for (name, part), run in after.live.items()],
                "marks": {name: mark.isoformat() for name, mark in after.marks.items()},
                "buckets": after.buckets,
            }
        )
        files, path = self._files()
        before = self._newest()
        if before is not None:  # whoever published it may have died before marking its run
            files.createNewFile(path(self._marker(before["run_id"])))
        final = path(self.path(f"_published/{after.seq:012d}.json"))
        draft = path(self.path(f"_published/.{after.seq:012d}-{uuid.uuid4().hex}"))
        stream = files.create(draft, True)
        stream.write(text.encode())
        stream.close()
        self._rename(draft, final)
        files.createNewFile(path(self._marker(run_id)))
        for name in self._publications()[: -KEPT - 1]:
            files.delete(path(self.path(f"_published/{name}")), False)
        return after

    def _rename(self, draft, final) -> None:
        """Move a file to a name that must be free."""
        jvm = self.spark._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            final.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(context.makeQualified(draft), context.makeQualified(final), none)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            context.delete(draft, False)
            raise Conflict(str(final)) from None

    def read(
        self, state: State, table: str, schema: T.StructType, parts: Iterable[str] | None = None
    ) -> DataFrame:
        """Live rows with their part; only the folders of the wanted parts are listed."""
        wanted = None if parts is None else set(parts)
        folders = [
            f"{self.path(table)}/run_id={run}/{PART}={part}"
            for (name, part), run in state.live.items()
            if name == table and (wanted is None or part in wanted)
        ]
        with_part = T.StructType([*schema.fields, T.StructField(PART, T.StringType())])
        if not folders:
            return self.spark.createDataFrame([], with_part)
        reader = self.spark.read.schema(
            T.StructType([*with_part.fields, T.StructField("run_id", T.StringType())])
        )
        return reader.option("basePath", self.path(table)).parquet(*folders).drop("run_id")

    def write_parts(self, df: DataFrame, table: str, run_id: str, gathered: bool = False) -> set[str]:
        """Write a frame with a part column under the run; return the parts it has.

        The rebalance hint lets adaptive execution split large parts and join small ones into
        files of even size. Rows that are `gathered`, those of a part in few tasks, are written where they are.
        """
        path = f"{self.path(table)}/run_id={run_id}"
        df = df if gathered else df.hint("rebalance", PART)
        with freed_shuffles(self.spark):
            df.write.mode("overwrite").partitionBy(PART).parquet(path, compression="zstd")
        names = self._names(f"{table}/run_id={run_id}")
        return {unquote(name.removeprefix(f"{PART}=")) for name in names if name.startswith(f"{PART}=")}

    def stage(self, df: DataFrame, name: str, run_id: str, codec: str | None = None) -> DataFrame:
        """Write a step of a run once for its several readers."""
        with freed_shuffles(self.spark):
            df.write.mode("overwrite").parquet(self._step(name, run_id), compression=codec)
        return self.staged(name, df.schema, run_id)

    def staged(self, name: str, schema: T.StructType, run_id: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._step(name, run_id))

    def _step(self, name: str, run_id: str) -> str:
        return f"{self.path('_staged')}/run_id={run_id}/{name}"

    def drop_staged(self, run_id: str) -> None:
        """Remove the steps of a run that is over."""
        files, path = self._files()
        files.delete(path(self.path(f"_staged/run_id={run_id}")), True)

    def vacuum(self, state: State) -> list[str]:
        """Remove the folders of replaced tables that no live part is in; gives their paths.

        For a time when no other run is under way: what a run has written is live only once it is
        published. Logs keep every run.
        """
        files, path = self._files()
        gone = []
        for name in sorted({table for table, _ in state.live}):
            used = {f"run_id={run}" for (table, _), run in state.live.items() if table == name}
            gone += [f"{name}/{run}" for run in self._names(name) if run.startswith("run_id=") and run not in used]
        for folder in gone:
            files.delete(path(self.path(folder)), True)
        return gone

    def append(self, df: DataFrame, table: str, run_id: str) -> None:
        append_run(df.withColumn("run_id", F.lit(run_id)), self.path(table), "run_id")

    def log(self, table: str, schema: T.StructType) -> DataFrame:
        """All rows of a run-partitioned log with their run; empty before the first write."""
        full = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
        try:
            return self.spark.read.schema(full).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

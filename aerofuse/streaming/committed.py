"""A table of batches that stream jobs add to, read by what has been committed.

A batch is written to a folder of its own and counts once its commit is there: one small JSON file under
``_commits``, named by a running version, put in place by one rename. It names the stream (the id that
its checkpoint keeps), the batch and the folder. So a retried batch adds nothing twice, what a failed attempt left
behind is never read, and another checkpoint neither overwrites nor hides anything. Folders are merged by levels: when
WIDTH folders of a level are there, one of the next level replaces them in one commit, so about WIDTH folders a level
are live, and levels grow with the logarithm of the number of batches.

One writer at a time: a writer that finds its version taken fails, and its batch is tried again by the stream.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

WIDTH = 8


@dataclass(frozen=True)
class Commit:
    version: int
    stream: str
    batch: int
    folder: str
    level: int
    replaces: tuple[str, ...] = ()


class ConflictError(RuntimeError):
    """Another writer has committed meanwhile."""


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> None:
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    def _place(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._place().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def commits(self) -> list[Commit]:
        """All commits, the oldest first."""
        files, folder = self._files(), self._place("_commits")
        if not files.exists(folder):
            return []
        found = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName().endswith(".json")]
        out = []
        for place in found:
            stream = files.open(place)
            try:
                fields = json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
            finally:
                stream.close()
            out.append(Commit(**{**fields, "replaces": tuple(fields["replaces"])}))
        return sorted(out, key=lambda c: c.version)

    def live(self, commits: list[Commit] | None = None) -> list[Commit]:
        """The commits whose folders make up the table."""
        commits = self.commits() if commits is None else commits
        gone = {f for c in commits for f in c.replaces}
        return [c for c in commits if c.folder not in gone]

    def _commit(self, commit: Commit) -> None:
        files = self._files()
        final, draft = self._place("_commits", f"{commit.version:012d}.json"), self._place("_commits", f".{uuid.uuid4().hex}")
        out = files.create(draft, False)
        try:
            out.write(bytearray(json.dumps({**commit.__dict__, "replaces": list(commit.replaces)}).encode()))
        finally:
            out.close()
        if files.exists(final) or not files.rename(draft, final):
            files.delete(draft, False)
            raise ConflictError(f"{self.path}: version {commit.version} is taken")

    def _write(self, df: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.hint("rebalance", *self.partition_by) if self.partition_by else df
        writer = rows.write
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/{folder}")
        return folder

    def holds(self, stream: str, batch: int) -> bool:
        return any(c.stream == stream and c.batch == batch and c.level == 0 for c in self.commits())

    def streams(self) -> set[str]:
        return {c.stream for c in self.commits() if c.level == 0}

    def add(self, df: DataFrame, stream: str, batch: int) -> bool:
        """Add the rows of a batch, unless that batch has been committed; tells whether it was added."""
        commits = self.commits()
        if any(c.stream == stream and c.batch == batch and c.level == 0 for c in commits):
            return False
        folder = self._write(df)
        version = commits[-1].version + 1 if commits else 0
        self._commit(Commit(version, stream, batch, folder, 0))
        self.compact(df.schema)
        return True

    def compact(self, schema: T.StructType, width: int = WIDTH) -> None:
        """Merge the folders of every level that has ``width`` of them into one of the next level."""
        while True:
            commits = self.commits()
            live = self.live(commits)
            full = next((n for n in sorted({c.level for c in live}) if sum(c.level == n for c in live) >= width), None)
            if full is None:
                return
            some = [c for c in live if c.level == full]
            folder = self._write(self._read([c.folder for c in some], schema))
            self._commit(Commit(commits[-1].version + 1, "compaction", -1, folder, full + 1, tuple(c.folder for c in some)))

    def _read(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        parts = [self.spark.read.schema(schema).parquet(f"{self.path}/{f}") for f in folders]
        whole = parts[0]
        for other in parts[1:]:
            whole = whole.unionByName(other)
        return whole

    def read(self, schema: T.StructType) -> DataFrame:
        """All committed rows."""
        return self._read([c.folder for c in self.live()], schema)

    def remove_unused(self) -> int:
        """Delete folders that no live commit names: merged ones, and what failed attempts left. Call it while nothing
        reads or writes the table; returns how many there were."""
        files, data = self._files(), self._place("data")
        if not files.exists(data):
            return 0
        live = {c.folder.rsplit("/", 1)[1] for c in self.live()}
        unused = [s.getPath() for s in files.listStatus(data) if s.getPath().getName() not in live]
        for place in unused:
            files.delete(place, True)
        return len(unused)


def stream_id(spark: SparkSession) -> str:
    """Inside ``foreachBatch``: the id that the checkpoint of the running stream keeps."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")

"""Serving tables with an upsert by key, on plain Parquet.

Every write makes a folder of its own under ``data``, and a commit names the folders that make up the table: a small file
in ``commits``, written aside and renamed to the next number. Readers take the folders of the newest commit, so they
see a batch wholly or not at all, and a write that dies leaves the table as it was. Batch N of a stream replaces the
folder of an earlier attempt at batch N.

Readers keep one row per key. Batches are not split by day, as one with late rows of many days would leave a file for
each; they are sorted by day, so that row group statistics prune. When a level has ``fanout`` folders, the writer
folds these into one of the next level, partitioned by day, and so on: the number of folders grows with the logarithm
of the batches, and a row is written again once a level. As "one row per key in a fixed order" gives the same answer
on folded and unfolded rows, folding never changes what is read. Folders that no commit names any longer are
deleted when they are older than ``keep`` seconds, as a reader may still be at work on them.

A table belongs to one stream and its checkpoint, which numbers the batches.
"""

from __future__ import annotations

import json
import time
from dataclasses import asdict, dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemill.operators.keyed import MOST_REPEATED, first_per_key, keep_listed, repeated, split
from tidemill.session import job_session


@dataclass(frozen=True)
class Part:
    """A live folder: the batches it holds and how often its rows were folded."""

    folder: str
    first: int
    last: int
    level: int = 0


@dataclass(frozen=True)
class KeyedTable:
    """``order`` names the columns by which the first row of a key wins; ``-name`` is descending.

    Keys must not move between values of ``partition``, such as the day of an order.
    """

    path: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ("-batch_id",)
    partition: str | None = None
    fanout: int = 8
    keep: float = 3600

    def create(self, spark: SparkSession) -> KeyedTable:
        for part in ("commits", "data"):
            there, files = folder(spark, f"{self.path}/{part}")
            files.mkdirs(there)
        return self

    def _order(self) -> list[Column]:
        return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c) for c in self.order]

    def _parts(self) -> list[str]:
        return [self.partition] if self.partition else []

    # Commits

    def _commits(self, spark: SparkSession) -> dict[int, float]:
        """The commits and when they were made, in seconds."""
        return {int(name.split(".")[0]): at for name, at in listed(spark, f"{self.path}/commits").items()
                if name.endswith(".json") and not name.startswith(("_", "."))}

    def _read_commit(self, spark: SparkSession, number: int) -> list[Part]:
        file, files = folder(spark, f"{self.path}/commits/{number:020d}.json")
        stream = files.open(file)
        try:
            found = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [Part(**part) for part in json.loads(found)]

    def live(self, spark: SparkSession) -> list[Part]:
        """The folders that make up the table."""
        numbers = self._commits(spark)
        return self._read_commit(spark, max(numbers)) if numbers else []

    def _commit(self, spark: SparkSession, parts: list[Part]) -> None:
        number = max(self._commits(spark), default=-1) + 1
        aside, files = folder(spark, f"{self.path}/commits/_{uuid4().hex}")
        stream = files.create(aside, True)
        try:
            stream.write(bytearray(json.dumps([asdict(p) for p in parts]).encode()))
        finally:
            stream.close()
        there, _ = folder(spark, f"{self.path}/commits/{number:020d}.json")
        if not files.rename(aside, there):
            raise RuntimeError(f"another writer made commit {number} of {self.path}")

    # Reading

    def _scan(self, spark: SparkSession, parts: list[Part]) -> DataFrame:
        # an explicit schema, or a day partition would come back as a date
        schema = StructType([*self.schema.fields, StructField("batch_id", LongType())])
        scans = []
        # folds are split by day, batches are not: two scans of different layouts
        for name in ("fold", "batch"):
            paths = [f"{self.path}/data/{p.folder}" for p in parts if p.folder.startswith(name)]
            if paths:
                whole = StructType([*schema.fields, StructField(name, StringType())])
                scan = spark.read.schema(whole).option("basePath", f"{self.path}/data").parquet(*paths)
                scans.append(scan.select(*schema.names))
        return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], schema)

    def rows(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """All stored rows with their batch, several per key; ``before`` leaves out later batches."""
        rows = self._scan(spark, [p for p in self.live(spark) if before is None or p.first < before])
        return rows if before is None else rows.where(F.col("batch_id") < before)

    def winners(self, rows: DataFrame) -> DataFrame:
        keys = [*self.keys, *(p for p in self._parts() if p not in self.keys)]
        return first_per_key(rows, keys, self._order())

    def read(
        self, spark: SparkSession, before: int | None = None, wanted: DataFrame | None = None, whole: bool = False
    ) -> DataFrame:
        """The table: one row per key. A filter on the partition column reaches the scan.

        ``wanted`` holds the keys to look up; other rows then end at the scan, before any shuffle of the
        table as long as the keys fit a broadcast. ``whole`` is for a reader of all rows of a table in which few keys
        come again: a job finds these at once by the hashes of all keys, and rows with other keys are not shuffled.
        """
        rows = self.rows(spark, before)
        if whole:
            keys = self.rows(job_session(spark), before).select(*self.keys)
            if few_repeated(keys, path := f"{self.path}/repeated-{uuid4().hex}"):
                alone, others = split(rows, self.keys, read_repeated(spark, path))
                return alone.unionByName(self.winners(others)).select(*self.schema.names)
        if wanted is not None:
            rows = keep_listed(rows, wanted, self.keys)
        return self.winners(rows).select(*self.schema.names)

    # Writing

    def upsert(self, batch: DataFrame, batch_id: int, gather: bool = True) -> None:
        """Store a batch, then fold what is due; the rows of a batch should already be unique by key.

        Without ``gather`` the rows are written where they lie, sorted by day in each file: for rows behind a shuffle,
        whose tasks AQE has sized.

        A batch without rows leaves no folder, not even that of a former attempt. Its rows are counted as they are
        written. An empty day is stored as no day: day folders do not tell the two apart. A batch that a fold holds
        was stored to its end; a replay of it is left out, as it would bring the same rows.
        """
        spark = batch.sparkSession
        live = self.live(spark)
        if any(p.level > 0 and p.first <= batch_id <= p.last for p in live):
            return
        rows = batch.select(*self.schema.names)
        if self.partition:
            rows = rows.withColumn(self.partition, F.nullif(F.col(self.partition), F.lit("")))
        # rebalance: few files for a small batch, even ones for a large batch; AQE splits a large day, without it the
        # rows are dealt evenly
        together = spark.conf.get("spark.sql.adaptive.enabled") == "true"
        if gather or not together:
            rows = rows.hint("rebalance", *(self._parts() if together else []))
        if self.partition:
            rows = rows.sortWithinPartitions(self.partition, *(k for k in self.keys if k != self.partition))
        rows = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        counted = Observation()
        part = Part(f"batch={batch_id}-{uuid4().hex}", batch_id, batch_id)
        rows.observe(counted, F.count("*").alias("n")).write.parquet(f"{self.path}/data/{part.folder}")
        others = [p for p in live if not (p.level == 0 and p.first == batch_id)]
        if counted.get["n"]:
            self._commit(spark, [*others, part])
        else:
            delete(spark, f"{self.path}/data/{part.folder}")
            if others != live:
                self._commit(spark, others)
        self.fold(spark)

    def fold(self, spark: SparkSession) -> None:
        """Fold every level that has ``fanout`` folders or more, then delete what is long out of use."""
        level, folded = 0, False
        while level <= max((p.level for p in self.live(spark)), default=-1):
            due = [p for p in self.live(spark) if p.level == level]
            if len(due) >= self.fanout:
                self._fold(spark, due, level + 1)
                folded = True
            level += 1
        if folded:
            self.vacuum(spark, self.keep)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to a committed one into one folder."""
        due = [p for p in self.live(spark) if p.last <= upto]
        if due:
            self._fold(spark, due, max(1, *(p.level for p in due)))

    def _fold(self, spark: SparkSession, due: list[Part], level: int) -> None:
        part = Part(f"fold={level}-{uuid4().hex}", min(p.first for p in due), max(p.last for p in due), level)
        rows = self._scan(spark, due)
        if len(due) > 1:
            # small days share a task, a day too large for one is split
            rows = self.winners(rows).hint("rebalance", *self._parts())
        # in a single folder no row replaces another, and its files hold few days each: only the layout changes. Were
        # a key repeated in its batch, readers keep one row of it, as they did before
        rows.write.partitionBy(*self._parts()).parquet(f"{self.path}/data/{part.folder}")
        # others may not have changed meanwhile: a table has one writer
        self._commit(spark, [*(p for p in self.live(spark) if p not in due), part])

    def vacuum(self, spark: SparkSession, age: float) -> None:
        """Delete commits older than ``age`` seconds except the newest, old folders that no commit left names, and what
        readers of the whole table left."""
        commits = self._commits(spark)
        if not commits:
            return
        edge = time.time() - age
        kept = [n for n in commits if n == max(commits) or commits[n] >= edge]
        named = {p.folder for n in kept for p in self._read_commit(spark, n)}
        for number in commits.keys() - set(kept):
            delete(spark, f"{self.path}/commits/{number:020d}.json")
        for name, at in listed(spark, f"{self.path}/data").items():
            # a folder that is just being written is not named yet, but young
            if name not in named and at < edge:
                delete(spark, f"{self.path}/data/{name}")
        for name, at in listed(spark, self.path).items():
            if name.startswith("repeated-") and at < edge:
                delete(spark, f"{self.path}/{name}")


def few_repeated(keys: DataFrame, path: str) -> bool:
    """Write the hashes of the keys that occur more than once to ``path``, as Spark plans the lookups by the size of the
    files; whether they are few."""
    repeated(keys).write.mode("overwrite").parquet(path)
    return read_repeated(keys.sparkSession, path).count() <= MOST_REPEATED


def read_repeated(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("_key bigint").parquet(path)


def folder(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, path: str) -> dict[str, float]:
    """What lies in a folder and when it was changed, in seconds."""
    there, files = folder(spark, path)
    if not files.exists(there):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in files.listStatus(there)}


def delete(spark: SparkSession, path: str) -> None:
    there, files = folder(spark, path)
    files.delete(there, True)

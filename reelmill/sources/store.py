"""Tables as versioned folders with one commit file for all of them.

A refresh writes a new folder while readers stay on the old one; publishing adds
one small commit file naming the current folder of every table, so several tables
change together or not at all. Works on any file system Spark can write whose
rename is atomic (HDFS, a shared mount, a local disk), not on plain object stores.

A job takes the ``version`` when it starts, reads its inputs at it (``pinned``) and names it when
it publishes; if one of those tables has moved since, the publish fails and changes nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from reelmill.operators.keys import require_not_null
from reelmill.session import sized_shuffles
from reelmill.sources.schemas import TABLES


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns by name in declared order and type; required columns checked as read."""
    typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return require_not_null(typed, [f.name for f in schema.fields if not f.nullable])


@dataclass(frozen=True)
class Version:
    """The number of a commit and the folder it gives each table."""

    number: int = 0
    tables: dict[str, str] = field(default_factory=dict)


class ConflictError(RuntimeError):
    """A table that a job read was published by another writer in the meantime."""


@dataclass(frozen=True)
class PinnedTables:
    """All tables of a store as of one commit, however many are published meanwhile."""

    store: TableStore
    version: Version

    def read(self, table: str) -> DataFrame:
        return self.store.read(table, self.version)

    def create_views(self, prefix: str = "") -> None:
        """Temporary views of every declared table, for SQL by name."""
        for table in self.store.schemas:
            self.read(table).createOrReplaceTempView(f"{prefix}{table}")


class TableStore:
    """Named tables under one root folder."""

    def __init__(
        self, spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.schemas = TABLES if schemas is None else schemas
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self._commits = self._path(f"{self.root}/_commits")
        self._fs = self._commits.getFileSystem(conf)
        self._context = self._hadoop.FileContext.getFileContext(self._commits.toUri(), conf)
        self._attempts: list[list[str]] = []

    def version(self) -> Version:
        """The latest commit; what a job reads and later publishes against."""
        return self._latest()

    def current(self) -> dict[str, str]:
        """Table name to the folder its readers use."""
        return self._latest().tables

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """The rows published last, or as of ``version``; a table never loaded is empty."""
        location = (version or self._latest()).tables.get(table)
        if location is None:
            return self.spark.createDataFrame([], self.schemas[table]).where("false")
        return self.read_staged(table, location)

    def read_staged(self, table: str, location: str) -> DataFrame:
        """The rows of one written folder, published or not."""
        return self.spark.read.schema(self.schemas[table]).parquet(location)

    def stage(self, table: str, df: DataFrame) -> str:
        """Write the rows as a new version that no reader sees yet."""
        location = f"{self.root}/{table}/{uuid.uuid4().hex}"
        rows = conform(df, self.schemas[table])
        for attempt in self._attempts:
            attempt.append(location)
        with sized_shuffles(rows):
            rows.write.mode("errorifexists").parquet(location)
        return location

    @contextmanager
    def attempt(self) -> Iterator[None]:
        """What is staged inside is deleted if the block fails before it is published."""
        staged: list[str] = []
        self._attempts.append(staged)
        try:
            yield
        except BaseException:
            used = set(self.current().values())
            self.discard(*[location for location in staged if location not in used])
            raise
        finally:
            self._attempts.remove(staged)

    def publish(
        self, staged: dict[str, str], base: Version | None = None, reads: Iterable[str] = ()
    ) -> None:
        """Make all staged versions current in one step.

        With ``base``, the version the job read, none of the staged tables and of
        ``reads`` may have moved since; commits to other tables are kept. The rename to
        the next number fails if another writer takes it in the same moment.
        """
        latest = self._latest()
        if base is not None:
            watched = {*staged, *reads}
            moved = sorted(t for t in watched if latest.tables.get(t) != base.tables.get(t))
            if moved:
                raise ConflictError(f"published by another writer meanwhile: {', '.join(moved)}")
        target = self._path(f"{self.root}/_commits/{latest.number + 1:012d}.json")
        draft = self._path(f"{self.root}/_commits/_{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({**latest.tables, **staged}), "utf-8"))
        finally:
            out.close()
        rename = getattr(self._hadoop, "Options$Rename")
        try:
            self._context.rename(draft, target, self.spark._sc._gateway.new_array(rename, 0))
        except Exception:
            self._fs.delete(draft, False)
            raise

    def discard(self, *locations: str) -> None:
        """Delete folders that were staged and will not be published."""
        for location in locations:
            self._fs.delete(self._path(location), True)

    @contextmanager
    def scratch(self) -> Iterator[str]:
        """A folder below the root for intermediate results, deleted at the end."""
        location = f"{self.root}/_scratch/{uuid.uuid4().hex}"
        try:
            yield location
        finally:
            self.discard(location)

    def full_refresh(self, table: str, df: DataFrame, skip_if_empty: bool = False) -> bool:
        """Replace a table. With ``skip_if_empty`` an empty input changes nothing.

        Emptiness is read off the files just written, so the input runs once.
        """
        location = self.stage(table, df)
        if skip_if_empty and self.read_staged(table, location).isEmpty():
            self.discard(location)
            return False
        self.publish({table: location})
        return True

    def pinned(self, version: Version | None = None) -> PinnedTables:
        """A handle that reads every table at one version, by default the latest."""
        return PinnedTables(self, version or self._latest())

    def create_views(self, prefix: str = "") -> None:
        """Temporary views of every declared table, all at one version."""
        self.pinned().create_views(prefix)

    def exists(self, location: str) -> bool:
        return self._fs.exists(self._path(location))

    def vacuum(self, older_than_hours: float = 0.0) -> None:
        """Delete folders that are no longer current and were last written so long ago.

        Give an age beyond the longest job: readers and writers may be at work then.
        """
        used = {location.rsplit("/", 1)[1] for location in self.current().values()}
        newest = (time.time() - older_than_hours * 3600) * 1000
        for table in [*self.schemas, "_scratch"]:
            folder = self._path(f"{self.root}/{table}")
            if not self._fs.exists(folder):
                continue
            for status in self._fs.listStatus(folder):
                old = status.getModificationTime() <= newest
                if old and status.getPath().getName() not in used:
                    self._fs.delete(status.getPath(), True)

    def _path(self, text: str):
        return self._hadoop.Path(text)

    def _latest(self) -> Version:
        if not self._fs.exists(self._commits):
            return Version()
        names = [s.getPath().getName() for s in self._fs.listStatus(self._commits)]
        numbered = sorted(n for n in names if n.endswith(".json") and n[0] not in "._")
        if not numbered:
            return Version()
        stream = self._fs.open(self._path(f"{self.root}/_commits/{numbered[-1]}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(int(numbered[-1].split(".")[0]), json.loads(text))

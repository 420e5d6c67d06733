"""Published sets of tables: every write goes to a folder of its own, one commit makes it visible.

Layout under a root::

    data/attempt=<id>/table=<name>[/<column>=<value>...]   never written to again
    commits/<id>/part-*.parquet                              one row, written last

A reader takes the newest commit (by version, then attempt) and reads the folders
that it names. A write that fails anywhere, its commit included, leaves no commit
behind: readers go on with what was committed before. A version that is written
again is another attempt of it with a commit of its own; nothing is replaced, so
whoever still reads the earlier attempt is not disturbed.

A commit lists its tables by *part*: a whole table, or one directory per value of
its first partition column. A later commit may take over parts of an earlier one,
so a write that touches a few parts writes only those. All folders are
``column=value``, which is why parts of many attempts are read as one partitioned
table, with partition pruning.

``expire`` removes what only old commits name. Commits and parts are listed on the
driver: one row per commit and a name per part (days, key buckets), never files.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlake.sources.paths import layer_path

DATA, COMMITS = "data", "commits"
#: Columns that a part's path adds to what is read from it.
FOLDER_COLUMNS = ("attempt", "table")
COMMIT_SCHEMA = (
    "version string, attempt int, id string, previous string, source string, committed_at timestamp, "
    "parts array<struct<table: string, part: string, path: string>>, rows map<string, bigint>, notes map<string, string>"
)


@dataclass(frozen=True)
class Part:
    """A table (``part`` is empty) or one value's directory of it; ``path`` is relative to the data folder."""

    table: str
    part: str
    path: str


@dataclass(frozen=True)
class Snapshot:
    """What one commit published."""

    root: str
    version: str
    attempt: int
    id: str
    previous: str | None  # the id of the snapshot it was made from
    source: str | None  # the id of the snapshot of another root that it reflects
    parts: tuple[Part, ...]
    rows: Mapping[str, int] = field(default_factory=dict)
    notes: Mapping[str, str] = field(default_factory=dict)

    def parts_of(self, table: str, only: Iterable[str] | None = None) -> list[Part]:
        wanted = None if only is None else set(only)
        return [p for p in self.parts if p.table == table and (wanted is None or p.part in wanted)]

    def read(
        self, spark: SparkSession, table: str, schema: StructType | None = None, only: Iterable[str] | None = None
    ) -> DataFrame:
        """The table, or some of its parts. Without a part there is nothing to take types from: give a schema."""
        data = layer_path(self.root, DATA)
        paths = [layer_path(data, p.path) for p in self.parts_of(table, only)]
        if not paths:
            if schema is None:
                raise ValueError(f"{self.root} publishes no table {table!r}")
            return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.option("basePath", data).parquet(*paths).drop(*FOLDER_COLUMNS)


def stamp() -> str:
    """The present instant as a version: sorts as text."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def _commits(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return (
            spark.read.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true").parquet(layer_path(root, COMMITS))
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def newest(spark: SparkSession, root: str, before: str | None = None) -> Snapshot | None:
    """The newest commit (``before``: of versions older than that), or None if there is none."""
    commits = _commits(spark, root)
    if commits is None:
        return None
    if before is not None:
        commits = commits.where(F.col("version") < before)
    row = commits.agg(F.max_by(F.struct(*commits.columns), F.struct("version", "attempt", "id")).alias("c")).first()["c"]
    if row is None:
        return None
    return Snapshot(
        root, row["version"], row["attempt"], row["id"], row["previous"], row["source"],
        tuple(Part(p["table"], p["part"], p["path"]) for p in row["parts"]), row["rows"] or {}, row["notes"] or {},
    )


def noted(spark: SparkSession, root: str, note: str, after: str | None = None) -> dict[str, str]:
    """Committed versions (``after``: newer ones) and what their last attempt noted, oldest first."""
    commits = _commits(spark, root)
    if commits is None:
        return {}
    if after is not None:
        commits = commits.where(F.col("version") > after)
    last = commits.groupBy("version").agg(F.max_by(F.col("notes")[note], F.struct("attempt", "id")).alias("note"))
    return {r["version"]: r["note"] for r in last.where("note is not null").orderBy("version").collect()}


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _folders(spark: SparkSession, path: str) -> dict[str, dt.datetime]:
    """Names of the folders directly under ``path``, and when each was last changed."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return {}
    found = [s for s in files.listStatus(target) if s.isDirectory()]
    return {s.getPath().getName(): dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc) for s in found}


class Attempt:
    """A write in progress: tables go below ``path``, then ``commit``."""

    def __init__(self, spark: SparkSession, root: str, version: str, before: str | None = None):
        """``before``: made from the newest snapshot older than that version (default: from the newest)."""
        self.spark, self.root, self.version = spark, str(root), version
        self.base = newest(spark, root, before)
        commits = _commits(spark, root)
        made = None if commits is None else commits.where(F.col("version") == version).agg(F.max("attempt")).first()[0]
        self.attempt = (made or 0) + 1
        self.id = f"{version}-{self.attempt:04d}-{uuid.uuid4().hex[:8]}"
        self.path = layer_path(self.root, f"{DATA}/attempt={self.id}")

    @staticmethod
    def folder(table: str) -> str:
        """The table's folder below ``path``."""
        return f"table={table}"

    def written(self, table: str, by_part: bool = False) -> list[Part]:
        """The table as a part, or the directories that its first partition column has now."""
        below = f"attempt={self.id}/{self.folder(table)}"
        if not by_part:
            return [Part(table, "", below)]
        names = [n for n in _folders(self.spark, layer_path(self.path, self.folder(table))) if "=" in n]
        return [Part(table, n.split("=", 1)[1], f"{below}/{n}") for n in sorted(names)]

    def commit(
        self, parts: Iterable[Part], rows: Mapping[str, int], source: str | None = None, notes: Mapping[str, str] | None = None
    ) -> Snapshot:
        """Make the attempt the newest snapshot. Until its one file is there, nothing has changed for readers."""
        parts = tuple(parts)
        record = {
            "version": self.version, "attempt": self.attempt, "id": self.id, "previous": self.base.id if self.base else None,
            "source": source, "parts": [vars(p) for p in parts], "rows": dict(rows), "notes": dict(notes or {}),
        }
        row = self.spark.range(1).select(F.from_json(F.lit(json.dumps(record)), COMMIT_SCHEMA).alias("c")).select("c.*")
        row.withColumn("committed_at", F.current_timestamp()).coalesce(1).write.parquet(layer_path(self.root, f"{COMMITS}/{self.id}"))
        return Snapshot(
            self.root, self.version, self.attempt, self.id, record["previous"], source, parts, record["rows"], record["notes"]
        )


def expire(spark: SparkSession, root: str, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=7)) -> list[str]:
    """Remove commits that are neither among the newest ``keep`` nor younger than ``older_than``, then the
    data folders that no commit left names (unfinished attempts among them, once they are that old).
    Returns the ids removed."""
    commits = _commits(spark, root)
    if commits is None:
        return []
    limit = dt.datetime.now(dt.timezone.utc) - older_than
    order = F.struct("version", "attempt", "id")
    rows = commits.select("id", "parts.path", F.unix_micros("committed_at").alias("at")).orderBy(order.desc()).collect()
    left = [r for n, r in enumerate(rows) if n < max(1, keep) or r["at"] >= limit.timestamp() * 1e6]
    named = {path.split("/")[0] for r in left for path in r["path"]}
    gone = sorted({r["id"] for r in rows} - {r["id"] for r in left})
    files, _ = _file_system(spark, root)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in gone:
        files.delete(hadoop_path(layer_path(root, f"{COMMITS}/{name}")), True)
    for name, changed in _folders(spark, layer_path(root, DATA)).items():
        if name not in named and changed < limit:
            files.delete(hadoop_path(layer_path(root, f"{DATA}/{name}")), True)
    return gone

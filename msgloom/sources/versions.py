"""Versioned tables split by hash prefix: loads write the prefixes they touch, readers follow a commit.

Below the table's folder:

- `loads/<load>/prefix=…`: the rows of one hash prefix that one load wrote; never changed afterwards;
- `manifests/version=…`: the folders that make up each prefix in a version, and figures of them;
- `commits/<version>`: an empty file; it is made last, and only if it isn't there.

A version is what its manifest names, and exists from the moment its commit file does. A load that
dies before leaves readers on the version they had; what it wrote is named by no manifest and
goes with `vacuum`. Two loads at a time can't both commit the same number.

A load either copies the prefixes it touches (`commit`), or adds its changed rows to them (`append`);
then readers take the newest row of each hash, and `compact` makes one folder of a prefix's many.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Hex digits of a prefix: 256 prefixes. One prefix should be a few GB at most, so larger tables take more.
DIGITS = 2
UNHASHED = "none"
#: Folders are written once and read by all later loads, so they are packed tightly.
CODEC = "zstd"

#: seq is the version that wrote the folder; batch is the last micro-batch that the whole version holds.
MANIFEST = "prefix string, path string, n_rows long, top_id long, seq long, batch long"
SEQ = "load_seq"


class CommitConflict(RuntimeError):
    """The version was committed by another load."""


class Folder:
    """A folder on any store that Spark reaches, through its own file system classes."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        """Names directly below a folder; none if it isn't there."""
        at = self._path(name)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def create(self, name: str) -> bool:
        """Make an empty file; False if it is there already."""
        at = self._path(name)
        if self.fs.exists(at):
            return False
        try:
            self.fs.create(at, False).close()
        except Exception as e:  # lost against another writer
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def prefix_of(hash_col: Column, digits: int = DIGITS) -> Column:
    """The prefix of a hash in hex; rows without a hash have one of their own."""
    return F.coalesce(F.when(hash_col != "", F.substring(hash_col, 1, digits)), F.lit(UNHASHED))


class VersionedTable:
    """One table of rows with a hash column, in the layout above."""

    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, hash_col: str = "md5_hash", digits: int = DIGITS):
        self.spark, self.base, self.schema = spark, base.rstrip("/"), schema
        self.hash_col, self.digits = hash_col, digits
        self.folder = Folder(spark, base)

    # --- Versions -------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return sorted(int(n) for n in self.folder.names("commits") if n.isdigit())

    def current(self) -> int:
        """The newest committed version; 0 for a table without one."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> DataFrame:
        version = self.current() if version is None else version
        if version == 0:
            return self.spark.createDataFrame([], MANIFEST)
        if not self.folder.exists(f"commits/{version}"):
            raise ValueError(f"version {version} of {self.base} was not committed")
        return self.spark.read.schema(MANIFEST).parquet(f"{self.base}/manifests/version={version}")

    def parts(self, version: int | None = None) -> list[dict]:
        """Manifest rows: one for each folder of a prefix, whatever the size of the table."""
        return [r.asDict() for r in self.manifest(version).collect()]

    def by_prefix(self, version: int | None = None) -> dict[str, list[dict]]:
        found: dict[str, list[dict]] = {}
        for part in self.parts(version):
            found.setdefault(part["prefix"], []).append(part)
        return found

    def top_id(self, version: int | None = None) -> int:
        """The highest id of a version, from its manifest."""
        return max((p["top_id"] or 0 for p in self.parts(version)), default=0)

    def last_batch(self) -> int:
        """The last micro-batch in the newest version; -1 if there is none."""
        return max((p["batch"] for p in self.parts() if p["batch"] is not None), default=-1)

    # --- Reading --------------------------------------------------------------------------

    def read(self, version: int | None = None, prefixes: Iterable[str] | None = None) -> DataFrame:
        """Rows of a version, of some prefixes only if given: other folders are not listed or read.

        Where a prefix has several folders, the newest row of each hash counts.
        """
        known = self.by_prefix(version)
        wanted = sorted(known) if prefixes is None else sorted(set(prefixes) & set(known))
        path = lambda part: f"{self.base}/{part['path']}"
        plain = [path(p[0]) for p in map(known.get, wanted) if len(p) == 1]
        layered = [path(q) for p in map(known.get, wanted) if len(p) > 1 for q in p]
        rows = self._files(plain) if plain else None
        if layered:
            turn = F.row_number().over(Window.partitionBy(self.hash_col).orderBy(F.desc(SEQ), F.desc("id")))
            files = self._files(layered)
            newest = files.filter(F.col(self.hash_col).isNotNull()).withColumn("_turn", turn).filter("_turn = 1").drop("_turn")
            newest = newest.unionByName(files.filter(F.col(self.hash_col).isNull()))
            rows = newest if rows is None else rows.unionByName(newest)
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.select(*self.schema.fieldNames())

    def _files(self, paths: list[str]) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(SEQ, T.LongType())])
        return self.spark.read.schema(schema).parquet(*paths)

    # --- Writing --------------------------------------------------------------------------

    def write_parts(self, rows: DataFrame, version: int, dealt: bool = False) -> list[dict]:
        """Write rows below the folders of their prefixes and return the manifest rows; commits nothing.

        Rows that are dealt out by ranges of hashes already (dealt) are written where they are.
        """
        load = uuid.uuid4().hex
        staged = f"{self.base}/loads/{load}"
        keyed = rows.select(
            *self.schema.fieldNames(),
            F.lit(version).cast("long").alias(SEQ),
            prefix_of(F.col(self.hash_col), self.digits).alias("prefix"),
        )
        keyed = keyed if dealt else keyed.hint("rebalance", "prefix")
        keyed.write.option("compression", CODEC).partitionBy("prefix").parquet(staged)
        schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("prefix", T.StringType())])
        written = self.spark.read.schema(schema).parquet(staged)
        figures = written.groupBy("prefix").agg(F.count("*").alias("n_rows"), F.max("id").alias("top_id")).collect()
        return [r.asDict() | {"path": f"loads/{load}/prefix={r['prefix']}", "seq": version} for r in figures]

    def commit(self, parts: list[dict], version: int, batch: int | None = None) -> int:
        """Make `version` of the given manifest rows; fails if it is there already."""
        conflict = CommitConflict(f"version {version} of {self.base} was committed by another load")
        if self.folder.exists(f"commits/{version}"):
            raise conflict
        if batch is None:
            batch = max((p["batch"] for p in parts if p.get("batch") is not None), default=None)
        rows = [(p["prefix"], p["path"], p["n_rows"], p["top_id"], p["seq"], batch) for p in parts]
        path = f"{self.base}/manifests/version={version}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(path)
        if not self.folder.create(f"commits/{version}"):
            raise conflict
        return version

    def replace(self, rows: DataFrame) -> int:
        """A new version that holds `rows` alone."""
        version = self.current() + 1
        return self.commit(self.write_parts(rows, version), version)

    def append(self, rows: DataFrame, batch: int | None = None) -> int:
        """A new version with rows that are newer than those of their hashes; the current one if there are none."""
        version = self.current()
        new = self.write_parts(rows, version + 1)
        return self.commit(self.parts(version) + new, version + 1, batch) if new else version

    def compact(self, min_parts: int = 2) -> int:
        """A new version in which each prefix of at least min_parts folders is one; the current one if none is."""
        version = self.current()
        known = self.by_prefix(version)
        deep = [p for p, parts in known.items() if len(parts) >= min_parts]
        if not deep:
            return version
        new = self.write_parts(self.read(version, deep), version + 1)
        kept = [part for p, parts in known.items() if p not in deep for part in parts]
        batch = max((q["batch"] for parts in known.values() for q in parts if q["batch"] is not None), default=None)
        return self.commit(kept + new, version + 1, batch)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove loads that none of the last `keep` versions names, and older versions; the removed loads.

        Not while a load runs: what it has written is not named yet.
        """
        versions = self.versions()
        kept = versions[-keep:]
        named = {p["path"].split("/")[1] for v in kept for p in self.parts(v)}
        for v in versions[:-keep]:
            self.folder.delete(f"commits/{v}")
            self.folder.delete(f"manifests/version={v}")
        gone = [n for n in self.folder.names("loads") if n not in named]
        for name in gone:
            self.folder.delete(f"loads/{name}")
        return gone

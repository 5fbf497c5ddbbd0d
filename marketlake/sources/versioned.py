"""A keyed table that is replaced atomically: sorted Parquet files, listed in a manifest per version.

Layout below the root: `files/<commit>/__run=<k>/...parquet` and `versions/<20 digits>.json`. A version's manifest lists its files with the
least and greatest value of the leading key column in each, and carries what else must change with the rows: a stream's last batch, a
watermark, counts. A commit writes new files, then the manifest under a temporary name, and renames it to the next number; the rename
fails if another writer took the number, and then the merge is made again on that writer's version. Readers open the files of one
version, so they never see half a commit. Files of old versions stay until vacuum().

An upsert reads and writes only the files whose key range the new rows touch. Which those are is found by search in the sorted ranges,
in every task over its own rows; the driver gets file numbers only. Touched files lie in runs of neighbours, each written as a run of
its own so that ranges stay apart; at most RUNS runs are kept, by closing the narrowest gaps (files in a closed gap are rewritten
too). New keys between two files go to the file before them.

The manifest is read by the driver, like any list of files that Spark plans a scan from. Keys: the leading key column is a number, string, date or timestamp
and not null; the others may be null. Rows with equal keys count as one, the last in the given order. Renaming must be atomic and refuse
an existing target, as in HDFS and local file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .tables import latest

#: Runs of touched files that are kept apart in one commit.
RUNS = 64

Merge = Callable[[DataFrame, DataFrame], DataFrame]


def comparable(kind: str) -> Callable[[str], int | float | str]:
    """What turns a bound's text into a value that sorts like the key's type."""
    return int if kind in ("byte", "short", "integer", "long") else float if kind in ("float", "double") else str


class Conflict(Exception):
    """Another writer committed the same version number first."""


@dataclass
class Version:
    """What a manifest says; files are (path, rows, low, high), sorted by low, with bounds as text that sorts like the key's own type casts."""

    number: int
    files: list[dict] = field(default_factory=list)
    properties: dict = field(default_factory=dict)


class VersionedTable:
    """rows of `schema` below `root`, unique by `keys`; `order` says which of several rows of a key is the last."""

    def __init__(self, spark: SparkSession, root: str, schema: str | StructType, keys: list[str], order: list[str] = (), file_rows: int = 1_000_000):
        self.spark, self.root, self.keys, self.order, self.file_rows = spark, root.rstrip("/"), list(keys), list(order), file_rows
        self.schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        self.lead = self.schema[self.keys[0]]

    # -- versions

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._path(self.root).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        fs, folder = self._fs(), self._path(f"{self.root}/versions")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> Version:
        """The manifest of a version, the newest if none is given; version 0 is the empty table."""
        if number is None:
            number = max(self.versions(), default=0)
        if not number:
            return Version(0)
        fs = self._fs()
        stream = fs.open(self._path(f"{self.root}/versions/{number:020d}.json"))
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        said = json.loads(text)
        return Version(number, said["files"], said["properties"])

    def _publish(self, new: Version) -> None:
        fs = self._fs()
        folder, target = self._path(f"{self.root}/versions"), self._path(f"{self.root}/versions/{new.number:020d}.json")
        fs.mkdirs(folder)
        temporary = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}.tmp")
        stream = fs.create(temporary, False)
        stream.write(bytearray(json.dumps({"files": new.files, "properties": new.properties}).encode()))
        stream.close()
        if fs.exists(target) or not fs.rename(temporary, target):
            fs.delete(temporary, False)
            raise Conflict(f"version {new.number} is there already")

    # -- reading

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of a version; they stay as they are while others commit."""
        return self._rows(self.version(number).files)

    def _rows(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f["path"] for f in files])

    # -- writing

    def upsert(self, new: DataFrame, merge: Merge | None = None, properties: dict | None = None, once: tuple[str, int] | None = None) -> Version:
        """Merge new rows: by default the last row of a key in `order` wins. merge(old, new) sees the rows of touched files only.

        once: a stream's name and batch number. A batch that the newest version has already taken in changes nothing.
        """
        merge = merge or (lambda old, rows: latest(old.unionByName(rows), self.keys, self.order or self.keys))

        def change(base: Version) -> tuple[list[dict], list[dict], DataFrame]:
            touched = self._touched(new, base.files)
            runs = self._runs(touched, base.files)
            taken = {k for low, high in runs for k in range(low, high + 1)}
            old = [f for k, f in enumerate(base.files) if k in taken]
            rest = [f for k, f in enumerate(base.files) if k not in taken]
            lows = [base.files[low]["low"] for low, _ in runs]
            return rest, lows, merge(self._rows(old), new.select(*self.schema.names))

        return self._commit(change, properties, once)

    def replace(self, rows: DataFrame, properties: dict | None = None, once: tuple[str, int] | None = None) -> Version:
        """Replace the whole table."""
        return self._commit(lambda base: ([], [], latest(rows.select(*self.schema.names), self.keys, self.order or self.keys)), properties, once)

    def delete_up_to(self, bound, properties: dict | None = None, once: tuple[str, int] | None = None) -> Version:
        """Delete the rows whose leading key is at most bound; files that lie beyond it aren't read."""
        text = self._text(bound)

        def change(base: Version) -> tuple[list[dict], list[dict], DataFrame]:
            touched = [k for k, f in enumerate(base.files) if self._key(f["low"]) <= self._key(text)]
            rest = [f for k, f in enumerate(base.files) if k not in set(touched)]
            return rest, [], self._rows([base.files[k] for k in touched]).where(F.col(self.lead.name) > F.lit(bound))

        return self._commit(change, properties, once)

    def set(self, properties: dict, once: tuple[str, int] | None = None) -> Version:
        """A version with the same rows and other properties."""
        return self._commit(lambda base: (base.files, [], None), properties, once)

    def _commit(self, change, properties: dict | None, once: tuple[str, int] | None, tries: int = 5) -> Version:
        for _ in range(tries):
            base = self.version()
            said = {**base.properties, **(properties or {})}
            if once:
                name, batch = once
                if base.properties.get("batches", {}).get(name, -1) >= batch:
                    return base
                said["batches"] = {**base.properties.get("batches", {}), name: batch}
            rest, lows, rows = change(base)
            written = [] if rows is None else self._write(rows, lows)
            files = sorted([*rest, *written], key=lambda f: self._key(f["low"]))
            version = Version(base.number + 1, files, said)
            try:
                self._publish(version)
                return version
            except Conflict:
                continue
        raise Conflict(f"gave up after {tries} tries")

    def _write(self, rows: DataFrame, lows: list[str]) -> list[dict]:
        """Sorted files of file_rows rows each; rows from each of lows on go to files of their own."""
        name = f"{self.root}/files/{uuid.uuid4().hex}"
        bounds = F.array(*[F.lit(x).cast(self.lead.dataType) for x in lows[1:]]) if len(lows) > 1 else None
        run = F.size(F.filter(bounds, lambda x: x <= F.col(self.lead.name))) if bounds is not None else F.lit(0)
        staged = f"{name}-staged"  # rows are merged once, then counted and dealt out
        rows.withColumn("__run", run).write.parquet(staged)
        made = self.spark.read.schema(StructType([*self.schema.fields]).add("__run", "integer")).parquet(staged)
        n = max(1, -(-made.count() // self.file_rows))
        order = ["__run", *self.keys]
        made.repartitionByRange(n, *order).sortWithinPartitions(*order).write.partitionBy("__run").parquet(name)
        self._fs().delete(self._path(staged), True)
        files = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(name)
        lead = F.col(self.lead.name)
        bounds_of = files.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"), F.min(lead).cast("string").alias("low"), F.max(lead).cast("string").alias("high"))
        return [r.asDict() for r in bounds_of.collect()]  # a row per new file

    # -- which files

    @staticmethod
    def _text(value) -> str:
        return str(value)

    def _key(self, text: str):
        return comparable(self.lead.dataType.typeName())(text)

    def _touched(self, new: DataFrame, files: list[dict]) -> list[int]:
        """Numbers of the files that can hold a new row's key, and of the file before a key that none can hold."""
        if not files:
            return []
        key = comparable(self.lead.dataType.typeName())
        lows, highs = [key(f["low"]) for f in files], [key(f["high"]) for f in files]

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from bisect import bisect_left, bisect_right

            found: set[int] = set()
            for batch in batches:
                for text in set(batch.column(0).to_pylist()):
                    first, last = bisect_left(highs, k := key(text)), bisect_right(lows, k)
                    found.update(range(first, last) if first < last else [max(last - 1, 0)])
            yield pa.RecordBatch.from_pydict({"file": pa.array(sorted(found), pa.int64())})

        return sorted(r.file for r in new.select(F.col(self.lead.name).cast("string")).mapInArrow(search, "file long").distinct().collect())

    def _runs(self, touched: list[int], files: list[dict]) -> list[tuple[int, int]]:
        """(first, last) of the runs of neighbours among touched files, RUNS at most."""
        runs = [(k, k) for k in touched]
        gaps = sorted(((b[0] - a[1], k) for k, (a, b) in enumerate(zip(runs, runs[1:], strict=False))), reverse=True)
        kept = {k for gap, k in gaps[: RUNS - 1] if gap > 1}
        out: list[tuple[int, int]] = []
        for k, (first, last) in enumerate(runs):
            if out and k - 1 not in kept:
                out[-1] = (out[-1][0], last)
            else:
                out.append((first, last))
        return out

    def vacuum(self, keep: int = 1) -> int:
        """Delete all but the newest `keep` versions and the files that none of these lists; returns the number of files deleted."""
        numbers = self.versions()
        held = {f["path"] for n in numbers[-keep:] for f in self.version(n).files}
        gone = {f["path"] for n in numbers[:-keep] for f in self.version(n).files} - held
        fs = self._fs()
        for n in numbers[:-keep]:
            fs.delete(self._path(f"{self.root}/versions/{n:020d}.json"), False)
        for path in gone:
            fs.delete(self._path(path), False)
        return len(gone)

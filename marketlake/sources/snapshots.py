"""Raw snapshots: nested JSON documents, one a file, plain or gzipped, in folders below one or more roots.

There may be a million files, and Spark's file sources hold a record of each in the driver, several times over. So tasks list the folders,
the list is a table, and tasks open the files that its rows name; the driver holds none of them. Both need a store that pyarrow opens
(file, hdfs, s3, gs); in any other, Spark's readers list and read. A file's stem (its name without .json or .json.gz) orders the snapshots
and is the watermark of incremental loads.
"""

from __future__ import annotations

import gzip
import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .folders import Scratch

#: The shape of a document; ad fields that nobody reads aren't parsed.
AD = "struct<ad_id:long,line:int,price4:long,size:string,trader:long,merchant:int,banks:array<struct<identifier:string>>>"
SIDE = f"struct<pages:array<struct<page:long,error:string,response:struct<data:array<{AD}>>>>>"
DOCUMENT = f"schema_version string, captured_at string, sides map<string, {SIDE}>, broken string"
VERSIONS = ("v1",)
#: Files that one task reads, and characters that one Arrow batch of them holds (or one file).
FILES, CHARACTERS = 2_000, 4_000_000


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.json|\.json\.gz)?$", 1)


def store_of(path: str):
    """pyarrow's store of a path, the path in it, and what stands before that in the full one; paths aren't escaped, as in Hadoop."""
    from pyarrow import fs

    if not (parts := re.match(r"([A-Za-z][A-Za-z0-9+.-]*://[^/]*)(.*)", path, re.DOTALL)):
        return fs.LocalFileSystem(), path.removeprefix("file:"), path[:5] if path.startswith("file:") else ""
    store, base = fs.FileSystem.from_uri(f"{parts[1]}/")
    base = base.rstrip("/")
    return store, base + parts[2], parts[1].removesuffix(base)


def opened(root: str) -> bool:
    """Whether pyarrow opens the store."""
    try:
        store_of(root)
    except (pa.ArrowException, OSError, ValueError):
        return False
    return True


def every_file(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, root (number of the root it is below) of every file, hidden ones left out; a task lists a folder, level by level."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            for folder, root in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path, start = store_of(folder)
                found = [f for f in store.get_file_info(fs.FileSelector(path)) if f.base_name[:1] != "." and (f.base_name[:1] != "_" or "=" in f.base_name)]
                paths, folders = [start + f.path for f in found], [f.type == fs.FileType.Directory for f in found]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array([root] * len(found), pa.int32()), pa.array(folders, pa.bool_())], names=["path", "root", "folder"])

    tables, parts = Scratch(spark, "listing"), []
    level = spark.createDataFrame([(root.rstrip("/"), k) for k, root in enumerate(roots)], "path string, root int")  # a row per root
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        found = tables.save(level.repartition(n, "path").mapInArrow(look, "path string, root int, folder boolean"), "level")
        parts.append(found.where("NOT folder").drop("folder"))
        level = found.where("folder").drop("folder")
        if level.isEmpty():
            break
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def listed(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, stem, root (number of the root it is below) of every .json and .json.gz file; contents aren't read."""
    if all(opened(root) for root in roots):
        out = every_file(spark, roots)
    else:
        parts = [spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.lit(k).alias("root")) for k, root in enumerate(roots)]
        out = parts[0]
        for part in parts[1:]:
            out = out.union(part)
    return out.where(F.col("path").rlike(r"\.json(\.gz)?$")).withColumn("stem", stem(F.col("path")))


def one_per_stem(files: DataFrame) -> DataFrame:
    """One file of each stem: .json.gz before .json, then the first root, then the least path."""
    order = F.struct(F.when(F.col("path").endswith(".json.gz"), 0).otherwise(1), "root", "path")
    return files.groupBy("stem").agg(F.min_by(F.struct("path", "root"), order).alias("f")).select("stem", "f.path", "f.root")


def documents_at(files: DataFrame) -> DataFrame:
    """path, stem and the document of every file that files (path) names, a batch or a stream; a file that isn't a document has its text
    in `broken` instead."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = lambda: pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (paths, texts)], names=["path", "text"])
        paths, texts, held = [], [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, name, _ = store_of(path)
                with store.open_input_stream(name, compression=None) as stream:
                    data = stream.read()
                if name.endswith(".gz"):
                    try:
                        data = gzip.decompress(data)
                    except (OSError, EOFError, zlib.error):  # no gzip: it stays as it is and is no document
                        pass
                paths.append(path)
                texts.append(data.decode(json.detect_encoding(data), "replace").lstrip("\ufeff"))
                held += len(texts[-1])
                if held >= CHARACTERS:
                    yield made()
                    paths, texts, held = [], [], 0
        if paths:
            yield made()

    read_ = files.select("path").mapInArrow(read, "path string, text string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}
    # a file may hold a list of documents; of a cut one Spark would give the fields before the cut, so it is read through for its end first
    is_list, through = F.col("text").rlike(r"^\s*\["), F.from_json("text", "schema_version string, broken string", options)
    many = F.when(is_list, F.from_json("text", f"array<struct<{DOCUMENT}>>", {"mode": "PERMISSIVE"})).otherwise(F.array(F.when(through["broken"].isNull(), F.from_json("text", DOCUMENT, options))))
    docs = read_.select("path", "text", F.explode_outer(many).alias("d"))
    broken = F.when(F.col("d").isNull(), F.col("text")).otherwise(F.col("d.broken"))
    return docs.select("path", stem(F.col("path")).alias("stem"), "d.*", broken.alias("__broken")).drop("broken").withColumnRenamed("__broken", "broken")


def _read(reader, root: str | list[str]) -> DataFrame:
    """Documents by Spark's reader, of a batch or a stream."""
    reader = reader.schema(DOCUMENT).option("recursiveFileLookup", True).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "broken")
    docs = reader.option("pathGlobFilter", "*.json*").json(root)
    return docs.select(F.col("_metadata.file_path").alias("path"), stem(F.col("_metadata.file_path")).alias("stem"), "*")


def dealt(files: DataFrame) -> DataFrame:
    """Files in as many parts as tasks are to read them."""
    return files.repartition(max(1, -(-files.count() // FILES), min(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), 200)), "path")


def read_documents(spark: SparkSession, roots: list[str]) -> DataFrame:
    """path, stem and the document of every file below the roots, as documents_at()."""
    if not all(opened(root) for root in roots):
        return _read(spark.read, roots)
    return documents_at(dealt(every_file(spark, roots).where(F.col("path").rlike(r"\.json[^/]*$"))))


def document_stream(spark: SparkSession, root: str, log: str | None = None) -> DataFrame:
    """The same as a stream of new files, whatever their stems: a late one is taken like any other.

    What is there when this is called and isn't in the folder `log` is written there, FILES names in a part; the stream is one of these
    parts, so that its checkpoint names parts and not files. A call that stops before the stream has run leaves its parts to the next.
    """
    if log is None or not opened(root):
        return _read(spark.readStream, root)
    found = every_file(spark, [root]).where(F.col("path").rlike(r"\.json[^/]*$")).select("path")
    try:
        found = found.join(spark.read.schema("path string").parquet(log), "path", "left_anti")
    except Exception as e:  # the first call
        if "PATH_NOT_FOUND" not in str(e):
            raise
    new = Scratch(spark, "new-files").save(found, "new")
    dealt(new).write.mode("append").parquet(log)
    names = spark.readStream.schema("path string").option("latestFirst", False).parquet(log)
    return documents_at(names.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def flatten(documents: DataFrame, versions: tuple[str, ...] = VERSIONS) -> DataFrame:
    """A row for each ad: stem, snapshot, side, page, ad_id, line, price4, size, trader, merchant, banks.

    Documents of other versions and pages that failed or have no answer give no rows; a size that is no number is NULL;
    banks without an identifier are left out.
    """
    docs = documents.where(F.col("schema_version").isin(*versions))
    sides = docs.select("stem", F.col("captured_at").alias("snapshot"), F.explode("sides").alias("side", "content"))
    pages = sides.select("stem", "snapshot", "side", F.explode("content.pages").alias("p")).where("p.error IS NULL AND p.response IS NOT NULL")
    ads = pages.select("stem", "snapshot", "side", "p.page", F.explode("p.response.data").alias("ad"))
    banks = F.filter(F.transform("ad.banks", lambda b: b["identifier"]), lambda b: b.isNotNull() & (b != ""))
    return ads.select("stem", "snapshot", "side", "page", "ad.ad_id", "ad.line", "ad.price4", F.expr("try_cast(ad.size AS BIGINT)").alias("size"), "ad.trader", "ad.merchant", F.coalesce(banks, F.array().cast("array<string>")).alias("banks"))


def failed_pages(documents: DataFrame) -> DataFrame:
    """stem, side, page, error of the pages that failed, and of sides without any page (page and error NULL): the gaps in the raw data."""
    sides = documents.select("stem", F.explode("sides").alias("side", "content"))
    pages = sides.select("stem", "side", F.explode_outer("content.pages").alias("p"))
    return pages.where("p IS NULL OR p.error IS NOT NULL OR p.response IS NULL").select("stem", "side", "p.page", "p.error")


def bad_files(documents: DataFrame) -> DataFrame:
    """n_files, n_bad: files that are no documents are counted and leave the others alone."""
    return documents.groupBy("path").agg(F.max((F.col("broken").isNotNull() & F.col("schema_version").isNull()).cast("int")).alias("bad")).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad"))


@dataclass
class Load:
    """What a load did: the watermark after it, its files, those that failed, and the rows that it read."""

    watermark: str | None
    files: int
    failed: int
    rows: int


class SnapshotTable:
    """The flattened ads of snapshot files as Parquet, one folder for each load, and a record of the loads beside them.

    Of a stem the rows of the last load that has any count, so repeating a load changes nothing. The record is written after
    the rows: readers see a load whole or not at all. A rebuild is the base; what was loaded before it isn't read again.
    """

    def __init__(self, spark: SparkSession, roots: list[str], target: str):
        self.spark, self.roots, self.target = spark, roots, target

    def _last(self) -> Row | None:
        """The record of the last load: watermark, n (its number), base (the last rebuild's)."""
        try:
            return self.spark.read.schema("watermark string, n long, base long").json(f"{self.target}/state").orderBy(F.desc("n")).first()
        except Exception as e:  # no load yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    def watermark(self) -> str | None:
        last = self._last()
        return last["watermark"] if last else None

    def rows(self) -> DataFrame:
        last = self._last()
        if last is None:
            raise ValueError("nothing has been loaded")
        # a folder above the record's number is of a load that didn't end
        ads = self.spark.read.parquet(f"{self.target}/ads/base={last['base']}").where(F.col("load") <= last["n"])
        if last["base"] < last["n"]:
            newest = ads.groupBy("stem").agg(F.max("load").alias("load"))
            ads = ads.join(newest, ["stem", "load"], "left_semi")
        return ads.drop("load")

    def _load(self, keep: Column, advance: bool, rebuild: bool = False) -> Load:
        before = self._last()
        n = before["n"] + 1 if before else 0
        # listed once, and each file parsed once: there may be a million of them
        base = n if rebuild or not before else before["base"]
        listing, parsed, ads = (f"{self.target}/{name}" for name in ("files", "documents", f"ads/base={base}/load={n}"))
        one_per_stem(listed(self.spark, self.roots)).where(keep).write.mode("overwrite").parquet(listing)
        files = self.spark.read.parquet(listing)
        if all(opened(root) for root in self.roots):
            docs = chosen = documents_at(dealt(files))
        else:
            docs = read_documents(self.spark, self.roots)
            plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
            chosen = docs.join(files.select(plain(F.col("path")).alias("chosen")), plain(docs["path"]) == F.col("chosen"), "left_semi")
        chosen.write.mode("overwrite").parquet(parsed)
        chosen = self.spark.read.schema(docs.schema).parquet(parsed)
        counts = bad_files(chosen).first()
        flatten(chosen).write.mode("overwrite").parquet(ads)
        last = files.agg(F.max("stem").alias("s")).first()["s"]
        mark = last if advance and last else before["watermark"] if before else None
        self.spark.createDataFrame([(mark, n, base)], "watermark string, n long, base long").write.mode("append").json(f"{self.target}/state")
        if before and base == n:  # what was loaded before a rebuild goes after its record
            flatten(chosen).limit(0).write.mode("overwrite").parquet(f"{self.target}/ads/base={before['base']}")
        return Load(mark, counts["n_files"], counts["n_bad"], self.spark.read.parquet(ads).count())

    def rebuild(self) -> Load:
        """Empty the table and load every file."""
        return self._load(F.lit(True), advance=True, rebuild=True)

    def load_new(self) -> Load:
        """Load the files above the watermark; there must be one."""
        mark = self.watermark()
        if mark is None:
            raise ValueError("no watermark: rebuild first")
        return self._load(F.col("stem") > mark, advance=True)

    def reload_since(self, day: str) -> Load:
        """Load the files from a day (yyyy-mm-dd) on again; the watermark stays."""
        return self._load(F.col("stem") >= day.replace("-", ""), advance=False)

    def status(self) -> dict:
        """watermark, files, pending, rows, snapshots."""
        mark = self.watermark()
        files = one_per_stem(listed(self.spark, self.roots)).agg(F.count("*").alias("n"), F.count_if(F.col("stem") > (mark or "")).alias("p")).first()
        rows = self.rows().agg(F.count("*").alias("n"), F.countDistinct("snapshot").alias("s")).first() if mark else {"n": 0, "s": 0}
        return {"watermark": mark, "files": files["n"], "pending": files["p"], "rows": rows["n"], "snapshots": rows["s"]}

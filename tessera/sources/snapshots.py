"""Versions of a partitioned table: immutable write folders and one manifest per version.

Layout below the table's path::

    write=w<id>/date=2024-01-01/part-….parquet    rows, never changed once written
    _index/write=w<id>/part-….parquet             (folder, partition columns, file, row_count) of a write
    _manifests/00000000000000000007.json          version 7: which write holds each folder's rows

A manifest appears whole or not at all and never replaces another: it is written under a temporary name and takes its
final one only if nobody has it (rename without overwriting; a hard link on a local disk).  So of two writers that
start from version 6 one becomes version 7.  The other reads version 7, carries over again what changed below it, and
becomes version 8.  Readers take the newest manifest and so see all folders of one version, or an older version by its
number.  A writer that dies before its manifest leaves files nobody refers to; ``vacuum`` removes them.

An object store needs a connector whose rename or create without overwriting is atomic.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFESTS, INDEX = "_manifests", "_index"
BUCKET = "bucket"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed: Spark's name of the folder of nulls


@dataclass(frozen=True)
class Snapshot:
    """One version: ``folders`` maps a folder's name (``date=2024-01-01``) to the write that holds its rows.  With
    ``buckets`` the folders are hash buckets of the partition columns."""
    version: int
    folders: dict[str, str]
    partition_cols: tuple[str, ...]
    buckets: int | None = None

    @property
    def folder_col(self) -> str:
        return BUCKET if self.buckets else self.partition_cols[0]

    def paths(self, path: str, only=None) -> list[str]:
        return [f"{path}/{w}/{f}" for f, w in sorted(self.folders.items()) if only is None or f in only]


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in folder_names(spark, f"{path}/{MANIFESTS}") if n.endswith(".json") and n[:-5].isdigit())


def _manifest(path: str, version: int) -> str:
    return f"{path}/{MANIFESTS}/{version:020d}.json"


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest version, or the one asked for; None if the table has none."""
    versions = _versions(spark, path)
    if version is not None and version not in versions:
        raise ValueError(f"{path} has no version {version}")
    if not versions:
        return None
    fs, p = file_system(spark, _manifest(path, versions[-1] if version is None else version))
    stream = fs.open(p)
    try:
        saved = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Snapshot(saved["version"], saved["folders"], tuple(saved["partition_cols"]), saved["buckets"])


def commit(spark: SparkSession, path: str, snap: Snapshot) -> bool:
    """Publish ``snap``; False if its number is taken."""
    jvm = spark.sparkContext._jvm
    fs, draft = file_system(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(_manifest(path, snap.version))
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps({"version": snap.version, "folders": snap.folders, "buckets": snap.buckets,
                                        "partition_cols": list(snap.partition_cols)}).encode()))
    finally:
        out.close()
    try:
        if fs.getUri().getScheme() == "file":
            def local(p):
                return jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(final), local(draft))
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration()
                                                                ).rename(draft, final, none)
    except Py4JJavaError as e:
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        if fs.exists(draft):
            fs.delete(draft, False)
    return True


def folder_value(partition_cols, buckets: int | None):
    """The column whose value names a row's folder."""
    if buckets:
        return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in partition_cols]), F.lit(buckets)).cast("int")
    return F.col(partition_cols[0])


def folders_of(keys: DataFrame, snap: Snapshot) -> set[str]:
    """Names of the folders that ``keys`` (partition columns in their types) lie in: one a day or bucket."""
    values = keys.select(folder_value(snap.partition_cols, snap.buckets).cast("string").alias("v")).distinct().collect()
    escape = keys.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return {f"{snap.folder_col}={NULL_FOLDER if r.v is None else escape(r.v)}" for r in values}


def same_key(left: DataFrame, right: DataFrame, cols) -> F.Column:
    """Null-safe equality of ``cols``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[c])
    return cond


def read(spark: SparkSession, path: str, schema: T.StructType, snap: Snapshot | None, only: set[str] | None = None) -> DataFrame:
    """Rows of a version, from all folders or ``only`` the named ones."""
    paths = [] if snap is None else snap.paths(path, only)
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*paths).select(*schema.fieldNames())


def read_index(spark: SparkSession, path: str, snap: Snapshot, only: set[str] | None = None) -> DataFrame:
    """(partition columns as strings, path, row_count) per partition and file of a version: no data file is opened."""
    live = [(w, f) for f, w in snap.folders.items() if only is None or f in only]
    schema = T.StructType([T.StructField("folder", T.StringType()), *[T.StructField(c, T.StringType()) for c in snap.partition_cols],
                           T.StructField("path", T.StringType()), T.StructField("row_count", T.LongType())])
    cols = [*snap.partition_cols, "path", "row_count"]
    if not live:
        return spark.createDataFrame([], schema).select(cols)
    index = (spark.read.schema(T.StructType([*schema.fields, T.StructField("write", T.StringType())]))
             .option("basePath", f"{path}/{INDEX}").parquet(*sorted({f"{path}/{INDEX}/{w}" for w, _ in live})))
    named = spark.createDataFrame([(w.split("=", 1)[1], f) for w, f in live], "write string, folder string")
    return index.join(named, ["write", "folder"], "left_semi").select(cols)


def _write(df: DataFrame, path: str, partition_cols, buckets: int | None, max_records: int) -> tuple[str, set[str]]:
    """Write rows to a new write folder, with its index; returns its name and the folders in it."""
    spark, write = df.sparkSession, f"write=w{uuid.uuid4().hex}"
    folder = BUCKET if buckets else partition_cols[0]
    out = df.withColumn(BUCKET, folder_value(partition_cols, buckets)) if buckets else df
    (out.hint("rebalance", folder).sortWithinPartitions(folder, *partition_cols)
     .write.option("maxRecordsPerFile", max_records).partitionBy(folder).parquet(f"{path}/{write}"))
    made = {n for n in folder_names(spark, f"{path}/{write}") if n.startswith(f"{folder}=")}
    if made:
        stored = T.StructType([T.StructField(c, T.StringType() if c == folder and not buckets else df.schema[c].dataType)
                               for c in partition_cols])
        file = F.col("_metadata.file_path")
        (spark.read.schema(stored).parquet(f"{path}/{write}")
         .groupBy(F.regexp_extract(file, "/([^/]+)/[^/]+$", 1).alias("folder"), *[F.col(c).cast("string").alias(c) for c in partition_cols],
                  file.alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
         .withColumn("folder", _decoded(F.col("folder")))
         .repartition(max(1, len(made) // 200)).write.parquet(f"{path}/{INDEX}/{write}"))
    return write, made


def _decoded(folder):
    """A folder's name as it stands on disk, from a file path that spells it as a URI."""
    return F.url_decode(F.regexp_replace(folder, r"\+", "%2B"))


def replace_partitions(df: DataFrame, path: str, partition_cols: list[str], max_records: int,
                       keys: DataFrame | None = None, buckets: int | None = None) -> Snapshot:
    """Replace exactly the partitions in ``keys`` (default: those present in ``df``) and publish a new version.

    A folder that is touched is written anew with its untouched partitions; a folder left without rows leaves the
    manifest.  If other writers published meanwhile, only the touched folders they changed are carried over again,
    from this writer's own files and theirs: neither loses rows, and of two writers of one partition the later one
    stays.  ``buckets`` counts for the first version of a table; later ones keep it.
    """
    spark, schema = df.sparkSession, df.schema
    base = snapshot(spark, path)
    if base is None and any("=" in n for n in folder_names(spark, path) if not n.startswith(("write=", "_"))):
        raise ValueError(f"{path} holds files without versions; write them to a new table first")
    shape = base or Snapshot(0, {}, tuple(partition_cols), buckets)
    if shape.partition_cols != tuple(partition_cols):
        raise ValueError(f"{path} is partitioned by {shape.partition_cols}")

    def typed(frame):
        return frame.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols]).distinct()

    wanted = typed(df if keys is None else keys)

    def carried(snap, folders):
        old = read(spark, path, schema, snap, folders)
        return old.join(wanted, same_key(old, wanted, partition_cols), "left_anti")

    touched = set()
    if base is not None or keys is not None:
        touched = folders_of(wanted, shape)
    rows = df if base is None else df.unionByName(carried(base, touched))
    write, made = _write(rows, path, partition_cols, shape.buckets, max_records)
    placed = {f: write for f in made}
    touched |= made
    while True:
        folders = {f: w for f, w in (base or shape).folders.items() if f not in touched} | placed
        new = Snapshot((base or shape).version + 1, folders, shape.partition_cols, shape.buckets)
        if commit(spark, path, new):
            return new
        latest = snapshot(spark, path)
        if latest.partition_cols != shape.partition_cols or latest.buckets != shape.buckets:
            raise ValueError(f"another writer made {path} with other partitions: {latest.partition_cols}, {latest.buckets}")
        before = {} if base is None else base.folders
        changed = {f for f in touched if latest.folders.get(f) != before.get(f)}
        if changed:
            mine = read(spark, path, schema, Snapshot(0, placed, shape.partition_cols, shape.buckets), changed)
            mine = mine.join(wanted, same_key(mine, wanted, partition_cols), "left_semi")
            write, made = _write(mine.unionByName(carried(latest, changed)), path, partition_cols, shape.buckets, max_records)
            placed = {f: w for f, w in placed.items() if f not in changed} | {f: write for f in made}
        base = latest


def vacuum(spark: SparkSession, path: str, keep_versions: int = 10, older_than_s: float = 7 * 86400.0) -> int:
    """Forget all but the newest versions, and delete the writes that none of those refers to and that are older than
    any writer or reader still at work.  Returns how many writes went."""
    versions = _versions(spark, path)
    kept = versions[-max(1, keep_versions):]
    live = {w for v in kept for w in snapshot(spark, path, v).folders.values()}
    for v in versions[:-len(kept)] if kept else []:
        fs, p = file_system(spark, _manifest(path, v))
        fs.delete(p, False)
    fs, p = file_system(spark, path)
    limit, gone = (time.time() - older_than_s) * 1000, 0
    for status in fs.listStatus(p) if fs.exists(p) else []:
        name = status.getPath().getName()
        if name.startswith("write=") and name not in live and status.getModificationTime() < limit:
            for folder in (f"{path}/{INDEX}/{name}", f"{path}/{name}"):
                fs.delete(file_system(spark, folder)[1], True)
            gone += 1
    return gone

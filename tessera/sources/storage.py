"""Parquet lake: partitioned / unpartitioned writes and strict / lenient reads
(B1–B11).

Layout: ``{root}/{asset}/`` is one table of versions (``sources.snapshots``).
A partitioned asset has one folder per value of its first partition column
(``date=…``), or with ``buckets`` that many folders by hash of its partition
columns, however many values there are; the partition columns are data columns
by which each folder's rows are sorted, so row groups prune on them.  Files then
hold a day, not a (day, station).  Replacing some (day, station) partitions
rewrites the days they touch, carries the untouched stations over and publishes
a new version: readers see the old one or the new one, and writers of one day at
the same time lose nothing.  Which partitions a version holds, with their files
and row counts, is read from its index.  The pipe-joined key string is derived
at the edge and never used as a physical path.

Writes cast to the declared schema first (the upstream JSON drifts: an
all-integer day must still be stored as double) and ask AQE to ``rebalance`` on
the folder column: a day holding a third of all rows is split over several tasks
and files, small ones are coalesced.  A table written by others without
manifests can be read, not written.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import encode_columns
from tessera.functions.timefn import as_col
from tessera.operators.ledger import MissingPartitionsError, latest_status
from tessera.schemas import REMOTE_SCHEMES, ROW_GROUP_ROWS, STATUS_MATERIALIZED
from tessera.sources import snapshots


def asset_path(root: str, asset_key: str) -> str:
    return os.path.join(root, asset_key)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the declared schema; absent columns become typed nulls."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_partitions(spark: SparkSession, path: str, keys: DataFrame, schema: T.StructType, partition_cols: list[str],
                    version: int | None = None) -> DataFrame:
    """Rows of the partitions of ``keys``, from their folders only: the days (or buckets) of ``keys`` choose the paths
    to scan and, for days, become literal partition filters; the exact keys follow as a semi-join."""
    wanted = keys.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols]).distinct()
    snap = snapshots.snapshot(spark, path, version)
    if snap is None:
        data = _plain(spark, path, schema)
    else:
        folders = snapshots.folders_of(wanted, snap)
        data = snapshots.read(spark, path, schema, snap, folders)
        if not snap.buckets and folders:
            data = data.filter(_in_folders(data, partition_cols[0], folders))
    return data.join(wanted, snapshots.same_key(data, wanted, partition_cols), "left_semi")


def _in_folders(data: DataFrame, col: str, folders: set[str]) -> F.Column:
    """The values that name ``folders``, as literals."""
    unescape = data.sparkSession.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [f.split("=", 1)[1] for f in sorted(folders)]
    values = [F.lit(unescape(n)).cast(data.schema[col].dataType) for n in names if n != snapshots.NULL_FOLDER]
    named = F.col(col).isin(values) if values else F.lit(False)
    return named | F.col(col).isNull() if snapshots.NULL_FOLDER in names else named


def _plain(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table that others wrote, without versions."""
    if not _path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def write_partitioned(df: DataFrame, root: str, asset_key: str, partition_cols: list[str],
                      schema: T.StructType | None = None, max_records_per_file: int = ROW_GROUP_ROWS,
                      keys: DataFrame | None = None, buckets: int | None = None) -> str:
    """B1 (+B3): replace exactly the partitions in ``keys`` (default: those
    present in ``df``).  A partition of ``keys`` without rows ends up empty;
    all others survive.  ``df`` must hold no other partitions than ``keys``."""
    publish_partitions(df, root, asset_key, partition_cols, schema, max_records_per_file, keys, buckets)
    return asset_path(root, asset_key)


def publish_partitions(df: DataFrame, root: str, asset_key: str, partition_cols: list[str],
                       schema: T.StructType | None = None, max_records_per_file: int = ROW_GROUP_ROWS,
                       keys: DataFrame | None = None, buckets: int | None = None) -> int:
    """``write_partitioned``; returns the number of the version it published."""
    out = conform(df, schema) if schema is not None else df
    return snapshots.replace_partitions(out, asset_path(root, asset_key), partition_cols, max_records_per_file, keys,
                                        buckets).version


def write_unpartitioned(df: DataFrame, root: str, asset_key: str, schema: T.StructType | None = None,
                        max_records_per_file: int = ROW_GROUP_ROWS) -> str:
    """B2 (+B3): replace the whole table."""
    out = conform(df, schema) if schema is not None else df
    path = asset_path(root, asset_key)
    out.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)
    return path


def file_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Rows per written file (footer metadata only, no column is decoded)."""
    return (spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file_path"))
            .groupBy("file_path").agg(F.count(F.lit(1)).alias("row_count")))


def read_unpartitioned(spark: SparkSession, root: str, asset_key: str, schema: T.StructType) -> DataFrame:
    """B7."""
    path = asset_path(root, asset_key)
    if not _path_exists(spark, path):
        raise MissingPartitionsError(f"Asset table {path} not found")
    return spark.read.schema(schema).parquet(path)


def read_all_partitions(spark: SparkSession, root: str, asset_key: str, schema: T.StructType,
                        version: int | None = None) -> DataFrame:
    """Fan in every partition of a partitioned table, of its newest version or the one asked for.

    The declared schema includes the partition columns, so keys such as
    station numbers stay strings (no partition-type inference).
    """
    path = asset_path(root, asset_key)
    snap = snapshots.snapshot(spark, path, version)
    return _plain(spark, path, schema) if snap is None else snapshots.read(spark, path, schema, snap)


def read_partitions_strict(spark: SparkSession, root: str, asset_key: str, keys: DataFrame,
                           schema: T.StructType, partition_cols: list[str]) -> DataFrame:
    """Load exactly ``keys``; any key without rows raises.  Presence is
    read from the version's index, not from the data."""
    path = asset_path(root, asset_key)
    wanted = keys.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols]).distinct()
    snap = snapshots.snapshot(spark, path)
    if snap is None:
        present = _plain(spark, path, schema).select(*partition_cols).distinct()
    else:
        present = snapshots.read_index(spark, path, snap).select(
            *[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols])
    sample = wanted.join(present, snapshots.same_key(wanted, present, partition_cols), "left_anti").limit(20).collect()
    if sample:
        raise MissingPartitionsError(f"Missing partitions: {[tuple(r) for r in sample]}")
    return read_partitions(spark, path, wanted, schema, partition_cols, snap and snap.version)


def loadable_keys(requested: DataFrame, ledger: DataFrame, asset_key: str,
                  partition_cols: list[str]) -> DataFrame:
    """Requested keys whose *latest* ledger status is MATERIALIZED.

    The ledger is first restricted to the requested keys (semi-join), so the
    latest-status aggregate only sees their events."""
    relevant = (ledger.filter(F.col("asset_key") == asset_key)
                .join(requested.select("partition_key"), "partition_key", "left_semi"))
    latest = (latest_status(relevant)
              .filter(F.col("status") == STATUS_MATERIALIZED).select("partition_key"))
    return requested.join(latest, "partition_key", "left_semi").select("partition_key", *partition_cols)


def missing_on_load(requested: DataFrame, ledger: DataFrame, asset_key: str,
                    partition_cols: list[str]) -> DataFrame:
    """Requested keys that are not (latest) materialized."""
    ok = loadable_keys(requested, ledger, asset_key, partition_cols).select("partition_key")
    return requested.join(ok, "partition_key", "left_anti")


def read_partitions_lenient(spark: SparkSession, root: str, asset_key: str, requested: DataFrame,
                            ledger: DataFrame, schema: T.StructType,
                            partition_cols: list[str]) -> DataFrame:
    """Load only requested partitions whose latest status is MATERIALIZED.

    ``requested`` carries ``partition_key`` plus the partition columns.  Zero
    loadable partitions or a missing table give an empty typed DataFrame.
    """
    keys = loadable_keys(requested, ledger, asset_key, partition_cols)
    return read_partitions(spark, asset_path(root, asset_key), keys, schema, partition_cols)


# Location rules: fixed scheme names.
_SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*)://"
_NETLOC_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
_PATH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"


def classify_location(df: DataFrame, col: str = "location") -> DataFrame:
    """Scheme, storage type (gs → gcs, none → local, else unsupported),
    bucket and trimmed prefix for gcs, and the separate "remote" rule."""
    loc = F.col(col)
    scheme = F.lower(F.regexp_extract(loc, _SCHEME_RE, 1))
    storage = (F.when(scheme == "gs", F.lit("gcs")).when(scheme == "", F.lit("local")))
    bucket = F.when(storage == "gcs", F.regexp_extract(loc, _NETLOC_RE, 1))
    prefix = F.when(storage == "gcs", F.regexp_replace(F.regexp_extract(loc, _PATH_RE, 1), r"^/+|/+$", ""))
    return df.select("*", scheme.alias("scheme"), storage.alias("storage_type"),
                     bucket.alias("bucket"), prefix.alias("prefix"),
                     scheme.isin(*REMOTE_SCHEMES).alias("is_remote"),
                     storage.isNotNull().alias("supported"))


def list_partition_files(spark: SparkSession, root: str, asset_key: str,
                         partition_cols: list[str], suffix: str = "parquet") -> DataFrame:
    """Partition keys that exist in storage, as strings.

    Of our tables, from the version's index.  Of tables that others wrote:
    folders by the first column (keys from a scan of the partition columns, so
    nothing is decoded from paths) and files named by their key,
    ``{asset}/{key}.parquet``, whose pipe-joined, maybe percent-encoded key is
    taken apart.
    """
    path = asset_path(root, asset_key)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in partition_cols])
    snap = snapshots.snapshot(spark, path)
    if snap is not None:
        return snapshots.read_index(spark, path, snap).select(*partition_cols).distinct()
    if not _path_exists(spark, path):
        return spark.createDataFrame([], schema)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", f"*.{suffix}").load(path).select("path"))
    in_folder = F.col("path").contains(f"/{partition_cols[0]}=")
    stem = F.url_decode(F.regexp_replace(F.regexp_extract("path", rf"/([^/]+)\.{suffix}$", 1), r"\+", "%2B"))
    parts = F.split(stem, r"\|")
    named = files.filter(~in_folder).select(*[F.get(parts, i).alias(c) for i, c in enumerate(partition_cols)])
    if not files.filter(in_folder).limit(1).collect():
        return named.distinct()
    data = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{partition_cols[0]}=*")
    return data.select(*partition_cols).unionByName(named).distinct()


def output_metadata(spark: SparkSession, path: str, asset_key: str, partition_cols: list[str],
                    now, schema: T.StructType, keys: DataFrame | None = None) -> DataFrame:
    """After a write, one ledger row per (partition, file) with its row
    count, for the partitions in ``keys`` (default: all of the asset)."""
    snap = snapshots.snapshot(spark, path)
    if snap is None:
        data = spark.read.schema(schema).option("basePath", path).parquet(path).select(
            *[F.col(c).cast("string").alias(c) for c in partition_cols], F.col("_metadata.file_path").alias("path"))
        counts = data.groupBy(*partition_cols, "path").agg(F.count(F.lit(1)).alias("row_count"))
    else:
        folders = None if keys is None else snapshots.folders_of(
            keys.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in partition_cols]), snap)
        counts = snapshots.read_index(spark, path, snap, folders)
    if keys is not None:
        wanted = keys.select(*[F.col(c).cast(schema[c].dataType).cast("string").alias(c) for c in partition_cols]).distinct()
        counts = counts.join(wanted, snapshots.same_key(counts, wanted, partition_cols), "left_semi")
    return counts.select(
        F.lit(asset_key).alias("asset_key"),
        encode_columns(*partition_cols).alias("partition_key"),
        *partition_cols,
        F.lit(STATUS_MATERIALIZED).alias("status"),
        as_col(now).alias("event_time"), "path", "row_count")

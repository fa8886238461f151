"""Partition space: day ranges, static values, grids, key encode/decode,
day <-> (day, station) mapping and backfill-request validation (P1–P9).

Every operator works on a *table* of requests, so a million backfill
requests cost one job.  None of them joins or collects: grids are built by
``explode`` per request row, which is linear in the output; only requests too
large for one task are dealt anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.keys import decode_key, dims_map, encode_key
from tessera.functions.timefn import as_col, day_range, last_closed_day
from tessera.schemas import FILE_TYPES, LOCATION_SCHEME, PARTITION_TZ, POLICIES, STORAGE_SCHEMES


def days_inclusive(requests: DataFrame, start: str = "start_date", end: str = "end_date",
                   out: str = "date") -> DataFrame:
    """One row per day from start to end, both included; none if start > end."""
    return requests.withColumn(out, F.explode(day_range(start, end)))


def days_closed(requests: DataFrame, now, start: str = "start_date", end: str | None = None,
                tz: str = PARTITION_TZ, out: str = "date") -> DataFrame:
    """Daily partitions from ``start`` up to the last finished zone-local day.

    With an ``end`` column the range is end-exclusive (``end - 1``) and still
    capped by the last finished day.  ``now`` is a timestamp column/literal.
    """
    upper = last_closed_day(as_col(now), tz)
    if end is not None:
        end_excl = F.date_sub(F.col(end), 1)
        upper = F.when(F.col(end).isNull(), upper).otherwise(F.least(upper, end_excl))
    return requests.withColumn(out, F.explode(day_range(start, upper)))


def static_values(requests: DataFrame, values: str = "stations", out: str = "station") -> DataFrame:
    """One row per listed value."""
    return requests.withColumn(out, F.explode(F.col(values)))


#: A request with more partitions than this is dealt over tasks in stretches of STRETCH_DAYS days.
ROW_PARTITIONS = 100_000
STRETCH_DAYS = 31


def partition_grid(requests: DataFrame, date_dims: dict[str, tuple[str, str]],
                   static_dims: dict[str, str], row_partitions: int = ROW_PARTITIONS) -> DataFrame:
    """Cartesian product of the dimensions *within each request row*.

    ``date_dims``: name -> (start column, end column), inclusive.
    ``static_dims``: name -> array column; a value that is listed twice counts once.
    Built with one ``explode`` per dimension, so there is no join.  A small
    request is expanded where it lies.  One of more than ``row_partitions``
    partitions is first cut into stretches of days, which are dealt over all
    tasks and expanded there.
    """
    size = F.lit(1.0)
    for s, e in date_dims.values():
        size = size * F.greatest(F.datediff(F.col(e), F.col(s)) + 1, F.lit(0))
    for arr in static_dims.values():
        size = size * F.size(F.array_distinct(F.col(arr)))
    sized = requests.withColumn("_large", F.coalesce(size > row_partitions, F.lit(False)))
    columns = list(dict.fromkeys([*requests.columns, *date_dims, *static_dims]))
    small = _expanded(sized.filter(~F.col("_large")), date_dims, static_dims).select(*columns)
    if not date_dims:
        return _expanded(sized, date_dims, static_dims).select(*columns)
    (name, (s, e)), *rest = date_dims.items()
    days = F.sequence(F.col(s), F.col(e), F.expr(f"interval {STRETCH_DAYS} days"))
    cut = sized.filter("_large").withColumn("_from", F.explode(days))
    cut = cut.repartition(F.xxhash64("_from", F.to_json(F.struct(*requests.columns))))
    cut = cut.withColumn("_to", F.least(F.date_add("_from", STRETCH_DAYS - 1), F.col(e)))
    large = _expanded(cut, {name: ("_from", "_to"), **dict(rest)}, static_dims).select(*columns)
    return small.unionByName(large)


def _expanded(df: DataFrame, date_dims: dict[str, tuple[str, str]], static_dims: dict[str, str]) -> DataFrame:
    for name, (s, e) in date_dims.items():
        df = df.withColumn(name, F.explode(day_range(s, e)))
    for name, arr in static_dims.items():
        df = df.withColumn(name, F.explode(F.array_distinct(F.col(arr))))
    return df


def day_ranges(partitions: DataFrame, group_cols: list[str], day: str) -> DataFrame:
    """Partitions -> stretches of consecutive days: (group_cols, first_day, last_day, n_days), null days left out.

    The days of a group are numbered after they were made distinct; days of one stretch all lie as far from their
    number.  A group (a request's station) has no more days than the calendar."""
    days = partitions.select(*group_cols, F.col(day).cast("date").alias("_day")).filter("_day IS NOT NULL").distinct()
    number = F.row_number().over(Window.partitionBy(*group_cols).orderBy("_day"))
    return (days.withColumn("_stretch", F.date_sub("_day", number)).groupBy(*group_cols, "_stretch")
            .agg(F.min("_day").alias("first_day"), F.max("_day").alias("last_day"), F.count(F.lit(1)).alias("n_days"))
            .drop("_stretch"))


def expand_ranges(ranges: DataFrame, out: str = "date") -> DataFrame:
    """Stretches of days -> their days (the inverse of ``day_ranges``)."""
    return ranges.withColumn(out, F.explode(day_range("first_day", "last_day"))).drop("first_day", "last_day", "n_days")


def with_partition_key(df: DataFrame, dims: list[str], out: str = "partition_key") -> DataFrame:
    """P5: dimension columns -> one key, values ordered by dimension *name*."""
    return df.withColumn(out, encode_key(dims_map(**{d: F.col(d) for d in dims})))


def split_partition_key(df: DataFrame, key: str, names: list[str]) -> DataFrame:
    """Key -> named dimension columns (``names`` in dimension-name order)."""
    return df.select("*", *decode_key(key, names))


def map_day_to_multi(daily: DataFrame, multi: DataFrame, day_col: str = "date",
                     daily_key: str = "daily_key", upstream_key: str = "partition_key") -> DataFrame:
    """For every daily partition, its upstream (day, station) partitions.

    Returned as (daily_key, upstream_key) rows: an equi-join on the day, never
    a per-day collected list, so a day with millions of stations is fine.
    """
    d = daily.select(F.col(day_col).alias("_day"), F.col(day_col).cast("string").alias(daily_key))
    m = multi.select(F.col(day_col).alias("_day"), F.col(upstream_key).alias("upstream_key"))
    return d.join(m, "_day", "inner").drop("_day")


def map_multi_to_day(multi: DataFrame, key: str = "partition_key", dim_index: int = 0,
                     out: str = "daily_key") -> DataFrame:
    """Each (day, station) key -> its daily key (a projection)."""
    return multi.withColumn(out, F.split(F.col(key), "\\|").getItem(dim_index))


def validate_backfills(requests: DataFrame) -> DataFrame:
    """Rule columns -> ``errors`` array and a ``valid`` flag.

    Rules: start and end given and start <= end (equality accepted); policy
    given and in {missing, all}; policy ``missing`` needs an asset key; file
    type given and in {parquet}; a ``location`` column, if there, is local or
    of a supported scheme.  A null never passes a rule by comparing as null.
    Dimension names being unique is enforced by the column layout itself.
    """
    rules = [
        F.when(F.col("start_date").isNull() | F.col("end_date").isNull(), F.lit("start_date or end_date missing")),
        F.when(F.col("start_date") > F.col("end_date"), F.lit("start_date after end_date")),
        F.when(F.col("policy").isNull(), F.lit("policy missing"))
        .when(~F.col("policy").isin(*POLICIES), F.concat(F.lit("unknown policy "), F.col("policy"))),
        F.when((F.col("policy") == "missing") & F.col("asset_key").isNull(),
               F.lit("policy missing needs asset_key")),
        F.when(F.col("file_type").isNull(), F.lit("type missing"))
        .when(~F.col("file_type").isin(*FILE_TYPES), F.concat(F.lit("unsupported type "), F.col("file_type"))),
    ]
    if "location" in requests.columns:
        scheme = F.lower(F.regexp_extract("location", LOCATION_SCHEME, 1))
        rules.append(F.when(~scheme.isin(*STORAGE_SCHEMES), F.concat(F.lit("unsupported scheme "), scheme)))
    errors = F.filter(F.array(*rules), lambda e: e.isNotNull())
    return requests.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)


def dimension_by_days(dim: DataFrame, start, end=None, out: str = "date") -> DataFrame:
    """Every row of a dimension table (e.g. stations) times every day in
    [start, end].  The bounds are columns, typically one scalar subquery
    returning ``struct(lo, hi)`` (pass it as ``start`` with ``end=None``) so
    the bounds are computed once: the day list is generated per dimension row
    by ``explode``, so no join and no shuffle is involved."""
    if end is None:
        d = dim.withColumn("_bounds", start)
        lo, hi = F.col("_bounds.lo"), F.col("_bounds.hi")
        return d.withColumn(out, F.explode(day_range(lo, hi))).drop("_bounds")
    return dim.withColumn(out, F.explode(day_range(start, end)))

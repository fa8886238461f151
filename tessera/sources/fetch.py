"""Response handling for the paginated REST API.

Raw responses are rows ``(request_id, page, status, body)``; ``body`` is the
JSON text of one page: ``{"pagination": {"current_page", "next_page"},
"data": [...]}`` (paginated) or ``{"data": {...}}`` (single object).
Bodies are parsed as VARIANT, once, JVM-side, so that what the sender got wrong
stays visible: each element of ``data`` is checked against the declared record
and either lands or becomes a reject with its reasons and its text.  The landing
zone keeps raw pages and can reparse them without refetching.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.keys import decode_key
from tessera.functions.timefn import day_bounds
from tessera.schemas import MEASUREMENT_RECORD, STATION, page_schema

log = logging.getLogger(__name__)

# Six fraction digits so timestamps survive the JSON round trip exactly; reading takes any ISO time.
JSON_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
JSON_OPTS = {"timestampFormat": JSON_TS}


def page_envelopes(rows: DataFrame, request_col: str, record_cols: list[str], order_cols: list[str],
                   page_size: int) -> DataFrame:
    """Wrap rows into paginated response pages (replay fixtures, raw landing).

    ``order_cols`` is (timestamp column, tie-breaker).  Records are numbered
    per request in that order with the two-level time-block rank (no request
    is sorted whole in one task); the page count per request is an aggregate
    joined back.  The last page's ``next_page`` equals its ``current_page``,
    which ends the chain; each page collects at most ``page_size`` records.
    """
    from tessera.operators.pacing import rank_in_time_order
    ts_col, tie_col = order_cols
    numbered = (rank_in_time_order(rows, request_col, ts_col, tie_col, out="_rn")
                .withColumn("page", F.ceil(F.col("_rn") / page_size).cast("int")))
    n_pages = (rows.groupBy(request_col).agg(F.count(F.lit(1)).alias("_n"))
               .select(request_col, F.ceil(F.col("_n") / page_size).cast("int").alias("_pages")))
    pages = numbered.groupBy(request_col, "page").agg(
        F.sort_array(F.collect_list(F.struct(F.col("_rn"), F.struct(*record_cols).alias("r")))).alias("_recs"))
    pages = pages.join(n_pages, request_col, "inner")
    body = F.to_json(F.struct(
        F.struct(F.col("page").alias("current_page"),
                 F.least(F.col("page") + 1, F.col("_pages")).alias("next_page")).alias("pagination"),
        F.transform("_recs", lambda x: x["r"]).alias("data")), JSON_OPTS)
    return pages.select(F.col(request_col).alias("request_id"), "page", F.lit(200).alias("status"),
                        body.alias("body"))


def empty_page(requests: DataFrame) -> DataFrame:
    """A single 200 page with ``data: []`` for each request (an empty day)."""
    return requests.select(F.col("request_id"), F.lit(1).alias("page"), F.lit(200).alias("status"),
                           F.lit('{"data":[]}').alias("body"))


#: A date, then maybe a time with any number of fraction digits and an offset (none: the session's zone, UTC).
ISO_TIME = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d*)?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*$"


#: Type that a variant takes only if it is of that shape; naming its whole schema costs more than parsing it.
_SHAPES = {"ARRAY": "array<variant>", "OBJECT": "map<string,variant>"}


def has_data(body: Column, shape: str) -> Column:
    """Whether a body is a JSON object whose ``data`` is a list (``ARRAY``) or an ``OBJECT``."""
    return F.try_variant_get(F.try_parse_json(body), "$.data", _SHAPES[shape]).isNotNull()


def _typed(record: Column, field: T.StructField) -> tuple[Column, Column]:
    """A field of a record in its declared type, and whether its value is there but not of that type."""
    path, kind = f"$['{field.name}']", field.dataType
    text = F.try_variant_get(record, path, "string")  # null for nothing and for JSON's null only
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        value = F.try_variant_get(record, path, kind.simpleString())
    elif isinstance(kind, (T.TimestampType, T.DateType)):
        value = F.when(text.rlike(ISO_TIME), text.try_cast(kind))  # no other JSON value looks like a time
    else:
        value = text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            value = F.when(F.abs(value) < float("inf"), value)  # neither NaN nor infinite
    return value, value.isNull() & text.isNotNull()


def checked_records(pages: DataFrame, record: T.StructType = MEASUREMENT_RECORD) -> DataFrame:
    """Every element of the pages' ``data`` lists: request_id, page, place (in the list), the fields of ``record``,
    ``extra`` (undeclared keys as strings), ``reasons`` (why it can't land; empty: it can) and ``raw`` (its JSON, of
    those that can't).

    Numbers may come as strings and times in any ISO form with 0 to 9 fraction digits (six are kept).  Missing and
    null fields are null.  An element that is no object, or has a field that is not of its type, can't land.
    """
    listed = F.try_variant_get(F.try_parse_json("body"), "$.data", "array<variant>")
    each = pages.select("request_id", "page", F.posexplode(listed).alias("place", "_r"))
    r = F.col("_r")
    whole = F.try_variant_get(r, "$", "map<string,string>")  # null unless an object
    fields = [(f, *_typed(r, f)) for f in record.fields]
    wrong = [F.when(bad, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")) for f, _, bad in fields]
    reasons = F.when(whole.isNull(), F.array(F.lit("not an object"))).otherwise(F.array_compact(F.array(*wrong)))
    known = [f.name for f in record.fields]
    extra = F.map_filter(whole, lambda k, _: ~k.isin(known))
    return each.select("request_id", "page", "place", *[v.alias(f.name) for f, v, _ in fields], extra.alias("extra"),
                       reasons.alias("reasons"), F.when(F.size(reasons) > 0, F.to_json(r)).alias("raw"))


def flatten_pages(pages: DataFrame, record: T.StructType = MEASUREMENT_RECORD, extra: bool = False) -> DataFrame:
    """Concatenate the ``data`` lists of all pages into rows.

    Elements that fail ``checked_records`` are left out; ``rejected_records``
    has them.  A page whose ``data`` is no list gives no row here; S7 calls it
    malformed, and a flow lets only requests through whose pages are all
    readable.  With ``extra`` the keys that ``record`` doesn't declare come
    along as a map of strings.
    """
    return landed_records(checked_records(pages, record), record, extra)


def landed_records(checked: DataFrame, record: T.StructType = MEASUREMENT_RECORD, extra: bool = False) -> DataFrame:
    """S2 from ``checked_records``."""
    return checked.filter(F.size("reasons") == 0).select("request_id", "page", *record.fieldNames(), *(["extra"] if extra else []))


def rejected_records(pages: DataFrame, record: T.StructType = MEASUREMENT_RECORD) -> DataFrame:
    """The elements that can't land: request_id, page, place, reasons, raw."""
    return rejects_of(checked_records(pages, record))


def rejects_of(checked: DataFrame) -> DataFrame:
    """The elements of ``checked_records`` that can't land."""
    return checked.filter(F.size("reasons") > 0).select("request_id", "page", "place", "reasons", "raw")


def page_links(pages: DataFrame) -> DataFrame:
    """``pages`` without their bodies: the number of each page (``cur``) and of the next (``nxt``; its own: none)."""
    pag = F.from_json("body", T.StructType([T.StructField("pagination", page_schema()["pagination"].dataType)]),
                      JSON_OPTS)
    cur = F.coalesce(F.col("_link")["pagination"]["current_page"], "page")
    return (pages.withColumn("_link", pag).withColumn("cur", cur)
            .withColumn("nxt", F.coalesce(F.col("_link")["pagination"]["next_page"], "cur")).drop("body", "_link"))


def page_chain_status(pages: DataFrame) -> DataFrame:
    """S3: per request, is the page chain complete?

    Complete = pages start at 1, every page's ``next_page`` points forward to
    a page that exists, and the only page pointing at itself (the end of the
    chain) is the last one.  A body without ``pagination`` is a one-page
    chain.  Links are resolved by a self-join on (request, page number) –
    unique keys, so even a request with millions of pages is spread over all
    tasks – and the verdict is a partially aggregated per-request summary.
    ``pages`` are bodies or already ``page_links``.
    """
    p = (pages if {"cur", "nxt"} <= set(pages.columns) else page_links(pages)).select("request_id", "cur", "nxt")
    targets = p.select("request_id", F.col("cur").alias("nxt"), F.lit(True).alias("_found"))
    linked = p.join(targets, ["request_id", "nxt"], "left")
    terminal = F.col("nxt") == F.col("cur")
    unresolved = ~terminal & (F.col("_found").isNull() | (F.col("nxt") < F.col("cur")))
    agg = linked.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.min("cur").alias("first_page"),
        F.max("cur").alias("last_page"),
        F.count_if(terminal).alias("_n_end"),
        F.max(F.when(terminal, F.col("cur"))).alias("_end"),
        F.min(F.when(unresolved, F.col("cur"))).alias("_unresolved"))
    broken = F.coalesce(F.col("_unresolved"),
                        F.when(F.col("_end").isNull() | (F.col("_end") != F.col("last_page")), F.col("_end")))
    ends_ok = (F.col("_n_end") == 1) & (F.col("_end") == F.col("last_page"))
    return (agg.withColumn("broken_at", broken)
            .withColumn("complete", (F.col("first_page") == 1) & F.col("_unresolved").isNull() & ends_ok)
            .drop("_n_end", "_end", "_unresolved"))


def single_objects(responses: DataFrame, record: T.StructType) -> DataFrame:
    """Non-paginated responses, ``data`` is one object -> one row
    (nested fields kept)."""
    schema = T.StructType([T.StructField("data", record)])
    return responses.select("request_id", F.from_json("body", schema, JSON_OPTS).alias("j")).select(
        "request_id", "j.data.*")


def request_params(keys: DataFrame, key_col: str = "partition_key", endpoint: str = "measurements") -> DataFrame:
    """Partition key ``date|station`` -> one request row with the day's
    bounds as offset-free labels ``dT00:00:00`` / ``dT23:59:59``."""
    date_c, station_c = decode_key(key_col, ["date", "station_number"])
    k = keys.select(F.col(key_col).alias("request_id"), date_c, station_c)
    start, end = day_bounds("date")
    return k.select("request_id", F.lit(endpoint).alias("endpoint"), "date", "station_number",
                    start.alias("start"), end.alias("end"))


def request_rows(params: DataFrame) -> DataFrame:
    """S5's rows as the requests that S1 sends: (request_id, endpoint, params_json)."""
    return params.select("request_id", "endpoint", F.to_json(F.struct("start", "end", "station_number")).alias("params_json"))


def enrich(records: DataFrame, requests: DataFrame) -> DataFrame:
    """Add station, start and end of the request to each returned row
    (equi-join on request_id; AQE broadcasts the request side when small)."""
    req = requests.select("request_id", "station_number", "start", "end", "date")
    return records.join(req, "request_id", "inner")


def classify_responses(responses: DataFrame, shape: str = "ARRAY") -> DataFrame:
    """2xx -> ``ok``; 500 -> ``dead_letter`` (no retries); any other
    status -> ``retry``.  With a ``body`` column, a 2xx answer whose body is no
    JSON with ``data`` of the expected shape is ``malformed``: a list
    (``ARRAY``) for paged requests, ``OBJECT`` for single ones."""
    s = F.col("status")
    good = (s >= 200) & (s < 300)
    outcome = F.when(good, F.lit("ok")).when(s == 500, F.lit("dead_letter")).otherwise(F.lit("retry"))
    if "body" in responses.columns:
        outcome = F.when(good & ~has_data(F.col("body"), shape), F.lit("malformed")).otherwise(outcome)
    return responses.withColumn("outcome", outcome)


def request_outcomes(classified: DataFrame) -> DataFrame:
    """Per request: ``ok`` only if every page is and the chain is complete
    (S3); ``dead_letter`` with any 500, else ``malformed`` with any such page,
    else ``retry``."""
    per = classified.groupBy("request_id").agg(
        F.max((F.col("outcome") == "dead_letter").cast("int")).alias("_dead"),
        F.max((F.col("outcome") == "malformed").cast("int")).alias("_bad"),
        F.min((F.col("outcome") == "ok").cast("int")).alias("_ok"))
    chains = page_chain_status(classified.filter(F.col("outcome") == "ok")).select("request_id", "complete")
    outcome = (F.when(F.col("_dead") == 1, F.lit("dead_letter")).when(F.col("_bad") == 1, F.lit("malformed"))
               .when((F.col("_ok") == 1) & F.col("complete"), F.lit("ok")).otherwise(F.lit("retry")))
    return per.join(chains, "request_id", "left").select("request_id", outcome.alias("outcome"))


def read_stations(spark: SparkSession, path: str, check_unique: bool = True) -> DataFrame:
    """Static station list, a JSON array of {location, number} objects
    (one or more files).  A missing file gives an empty table and a warning;
    duplicate numbers raise (checked with a bounded ``limit``)."""
    from tessera.sources.storage import _path_exists
    if not _path_exists(spark, path):
        log.warning("station list %s not found; no station partitions", path)
        return spark.createDataFrame([], STATION)
    df = (spark.read.schema(STATION).option("multiLine", True).option("recursiveFileLookup", True)
          .json(path).select(*STATION.fieldNames()))
    if check_unique:
        dup = df.groupBy("number").count().filter("count > 1").limit(5).collect()
        if dup:
            raise ValueError(f"duplicate station numbers: {[r['number'] for r in dup]}")
    return df


def write_station_list(df: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Write stations as JSON-array files (the format ``read_stations`` reads).

    Each file holds one hash bucket of about ``per_file`` stations, so no
    array grows with the station count; buckets are written in parallel.
    """
    files = max(1, -(-df.count() // per_file))
    arr = (df.groupBy(F.pmod(F.xxhash64("number"), F.lit(files)).alias("_b"))
           .agg(F.to_json(F.sort_array(F.collect_list(F.struct("location", "number")))).alias("value")))
    # One array per file: each bucket is its own folder holding one row.
    arr.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_b").text(path)

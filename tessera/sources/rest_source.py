"""Paginated REST API, one row per fetched page.

``fetch(requests, transport)`` takes a table of requests ``(request_id, endpoint,
params_json)`` and gives ``(request_id, page, status, body)``.  Spark reads the
requests, deals them to tasks and hands each task its requests one by one, so
the answer does not depend on how many tasks there are, and every file is read
through Spark's own file systems.  Transports:

* ``{"transport": "http", "base_url": ...}``, maybe with ``timeout`` in seconds
* ``{"transport": "replay", "replay": path}``: saved pages, a Parquet table
  ``(request_id, page, status, body)`` that Spark joins to the requests.  A
  request without any saved page raises.

A chain of pages follows ``pagination.next_page`` until it equals
``current_page``; there is no cap on its length.  An answer that is not 2xx ends
the chain and is a row, so errors are data (S7 classifies them) instead of
killing the job; a host that hangs, refuses or has no name is status 599.  A
chain that turns back to an earlier page ends with a row of status 508.  Pacing is planned beforehand (F11), so readers do not sleep.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ship_package

PAGES = "request_id string, page int, status int, body string"
_ARROW = pa.schema([("request_id", pa.string()), ("page", pa.int32()), ("status", pa.int32()), ("body", pa.string())])
#: Requests that one task fetches over HTTP.
REQUESTS_PER_TASK = 200
#: Status of the row that ends a chain which turns back (HTTP: loop detected).
LOOP_STATUS = 508
#: Status of the row for a page that no answer came for (network connect timeout).
NETWORK_STATUS = 599


def next_page(page: int, status: int, body: str | None) -> int | None:
    """The page to fetch after this one; None at the end of the chain, and the
    number of an earlier page if the chain turns back."""
    if not 200 <= status < 300 or body is None:
        return None
    try:
        links = json.loads(body).get("pagination")
        now, then = (links.get("current_page"), links.get("next_page")) if links else (None, None)
    except (ValueError, AttributeError):
        return None  # not readable: S7 sees the body
    return None if then is None or then == now else then


def fetch_chain(get, paginate: bool = True):
    """Follow one request's chain; ``get(page)`` gives (status, body).  Yields (page, status, body)."""
    page = 1
    while True:
        status, body = get(page)
        yield page, status, body
        then = next_page(page, status, body) if paginate else None
        if then is None:
            return
        if then <= page:
            yield then, LOOP_STATUS, None
            return
        page = then


class _HttpTransport:
    def __init__(self, base_url: str, timeout: float = 60.0):
        self.base_url = base_url.rstrip("/")
        self.timeout = timeout

    def get(self, endpoint, params, page):
        import http.client
        import urllib.error
        import urllib.parse
        import urllib.request
        q = dict(params)
        if page is not None:
            q["page"] = page
        url = f"{self.base_url}/{endpoint}?{urllib.parse.urlencode(q)}"
        try:
            with urllib.request.urlopen(url, timeout=self.timeout) as resp:
                return resp.status, resp.read().decode("utf-8")
        except urllib.error.HTTPError as e:
            return e.code, None
        except (OSError, http.client.HTTPException):  # time-outs, refused or broken connections, unknown hosts
            return NETWORK_STATUS, None


def _rows_out(rows, size: int = 500):
    """Arrow batches of fetched pages."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), _ARROW.types)], schema=_ARROW)


def _from_http(base_url: str, paginate: bool, timeout: float):
    def run(batches):
        transport = _HttpTransport(base_url, timeout)

        def rows():
            for batch in batches:
                for r in batch.to_pylist():
                    params = json.loads(r["params_json"]) if r["params_json"] else {}
                    for page in fetch_chain(lambda p: transport.get(r["endpoint"], params, p if paginate else None), paginate):
                        yield r["request_id"], *page

        yield from _rows_out(rows())

    return run


def _from_saved(paginate: bool):
    """Rows sorted by (request_id, page), page 0 being the request itself; follows each chain forward through its
    saved pages as they pass by, so a task holds one page at a time."""
    def run(batches):
        def rows():
            request, wanted, last = None, None, 1

            def missing():
                if wanted == 1:
                    raise ValueError(f"no saved page for request {request!r}")
                return request, wanted, 404, None

            for batch in batches:
                for own, page, status, body in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if page == 0:
                        if wanted is not None:
                            yield missing()
                        request, wanted = own, 1
                    elif own == request and page == wanted:
                        yield request, wanted, status, body
                        then = next_page(wanted, status, body) if paginate else None
                        if then is not None and then <= wanted:
                            yield request, then, LOOP_STATUS, None
                            then = None
                        wanted = then
            if wanted is not None:
                yield missing()

        yield from _rows_out(rows())

    return run


def fetch(requests: DataFrame, transport: dict[str, str], paginate: bool = True) -> DataFrame:
    """Fetched pages of all requests (each request_id once)."""
    spark = requests.sparkSession
    ship_package(spark)
    asked = requests.select("request_id", "endpoint", "params_json")
    if transport.get("transport", "replay") == "http":
        tasks = max(1, -(-requests.count() // REQUESTS_PER_TASK))
        return asked.repartition(tasks, "request_id").mapInArrow(
            _from_http(transport["base_url"], paginate, float(transport.get("timeout", 60))), PAGES)
    saved = spark.read.parquet(transport["replay"]).select("request_id", "page", "status", "body")
    both = asked.select("request_id", F.lit(0).alias("page"), F.lit(0).alias("status"), F.lit(None).cast("string").alias("body"))
    saved = saved.join(asked.select("request_id"), "request_id", "left_semi")  # pages nobody asked for stay where they are
    # dealt by a hash of the id: both sides of the union are dealt by the id itself, and then Spark would take the union
    # as dealt already, though adaptive execution may merge the partitions of its sides differently
    both = both.unionByName(saved).repartition(F.xxhash64("request_id")).sortWithinPartitions("request_id", "page")
    return both.mapInArrow(_from_saved(paginate), PAGES)

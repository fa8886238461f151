"""Helpers shared by the operators: table access, scratch tables, Arrow mapping."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register an ``opN_`` query of this subpackage."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) of every row; a null text becomes empty, all other columns are left behind."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def shielded(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``stage`` applied to docs whose columns other than doc_id, text and n_chars have names that nothing clashes
    with; its result with the columns of docs."""
    other = {n: f"_other_{i}" for i, n in enumerate(docs.columns) if n not in ("doc_id", "text", "n_chars")}
    out = stage(docs.withColumnsRenamed(other)).select([other.get(n, n) for n in docs.columns])
    return out.withColumnsRenamed({v: k for k, v in other.items()})


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared folder and read it back: cuts the lineage at a table that
    survives the loss of any executor."""
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_KEPT: dict = {}


def kept(key, make: Callable):
    """What an operator keeps in a Python worker from task to task (a vocabulary, a cache).  A worker holds one
    operator's at a time: whoever comes next with another key has the room, so a worker that serves one stage after
    the other does not add them up."""
    if key not in _KEPT:
        _KEPT.clear()
        _give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def _give_back() -> None:
    """Return freed memory to the system; long-lived workers would hold on to it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc
        libc.malloc_trim(0)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[dict]],
              schema: str | StructType) -> DataFrame:
    """mapInArrow whose ``fn`` yields dicts of columns in the order of ``schema``."""
    arrow = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for cols in fn(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in
                 zip((cols[f.name] for f in arrow), arrow, strict=True)], schema=arrow)
        _give_back()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, max_bytes: int, text_col: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text (one row at least), in order."""
    sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_pylist()
    at = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > max_bytes:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield batch.slice(at)

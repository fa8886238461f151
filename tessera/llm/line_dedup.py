"""Operator 13: lines that many documents share, marked in a keep bitmap per document.

A line's key is the line without white space at its ends and with A-Z lowered; an empty key is never dropped.  The
128-bit hashes of all keys are range-partitioned and sorted together with document and position, so a line that a
third of all documents hold spreads over as many partitions as its rows fill.  Each task streams its sorted rows: of
a run of equal hashes it keeps no more than the rows of the first ``min_docs - 1`` documents, then passes the rest
on as they come.  Only the first and the last run of a partition may go on next door; their counts (two rows a
partition) are added up by Spark, which then decides on the rows those runs kept back.  What is dropped becomes a
compressed bitmap per document; texts meet their bitmap in one join and are never sorted by line.
"""

from __future__ import annotations

import hashlib
import string
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType
from pyspark.sql.window import Window

from . import base

SPACE = " \t\n\x0b\x0c\r"
MIN_DOCS = 10
DROP, OPEN, RUN = 0, 1, 2
MARKS = "kind int, h1 bigint, h2 bigint, doc bigint, body bigint, pos int, n bigint, last_doc bigint, last_body bigint"
#: The columns by which rows are dealt and sorted.
ORDER = ["h1", "h2", "doc", "body", "pos"]


def _identified(docs: DataFrame) -> DataFrame:
    """docs with ``doc`` and ``body``, which tell documents apart: the id (null: 0, which ``body`` tells from an id
    of 0) and a hash of the text."""
    return docs.withColumns({"doc": F.coalesce("doc_id", F.lit(0)),
                             "body": F.xxhash64(F.col("doc_id").isNull(), F.col("text"))})


def line_hashes(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc, body, pos) of every line of ``docs`` (doc_id, text) whose key is not empty."""
    lines = _identified(docs).select("doc", "body", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)
    return lines.withColumn("key", key).filter("key != ''").select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"), "doc", "body", "pos")


class _Open:
    """The run at the end of what was read: its rows as long as they come from too few documents."""

    def __init__(self, at_start: bool, block: np.ndarray):
        self.at_start, self.blocks, self.n, self.first, self.last = at_start, [], 0, block[:, 0], None

    def add(self, block: np.ndarray, min_docs: int) -> np.ndarray | None:
        """Take in more rows (columns of ORDER); returns the rows known to be dropped by now."""
        docs = block[2:4]
        new = np.any(docs[:, 1:] != docs[:, :-1], axis=0).sum() + (
            self.last is None or not np.array_equal(self.last, docs[:, 0]))
        self.n, self.last = self.n + int(new), docs[:, -1].copy()
        self.blocks.append(block)
        if self.n < min_docs:
            return None
        out, self.blocks = np.concatenate(self.blocks, axis=1), []
        return out


def _columns(kind: int, block: np.ndarray) -> dict:
    m = block.shape[1]
    empty = pa.nulls(m, pa.int64())
    return {"kind": np.full(m, kind, "int32"), "h1": block[0], "h2": block[1], "doc": block[2], "body": block[3],
            "pos": block[4].astype("int32"), "n": empty, "last_doc": empty, "last_body": empty}


def _closed(run: _Open, at_end: bool, min_docs: int):
    """What is left to say of a run: nothing, or if it may go on next door its count and the rows kept back."""
    if not (run.at_start or at_end):
        return
    h1, h2, doc, body, pos = (int(v) for v in run.first)
    yield {"kind": [RUN], "h1": [h1], "h2": [h2], "doc": [doc], "body": [body], "pos": [pos], "n": [run.n],
           "last_doc": [int(run.last[0])], "last_body": [int(run.last[1])]}
    if run.blocks:
        yield _columns(OPEN, np.concatenate(run.blocks, axis=1))


def _stream(min_docs: int):
    """Sorted rows -> marks.  Rows of runs inside a batch are counted by column; the last run stays open."""
    def run(batches):
        now, started = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(c).to_numpy().astype("int64") for c in ORDER])
            cuts = np.flatnonzero(np.any(rows[:2, 1:] != rows[:2, :-1], axis=0)) + 1
            if now is not None and np.array_equal(now.first[:2], rows[:2, 0]):
                end = cuts[0] if len(cuts) else rows.shape[1]
                if (out := now.add(rows[:, :end], min_docs)) is not None:
                    yield _columns(DROP, out)
                rows, cuts = rows[:, end:], cuts[1:] - end
                if not rows.shape[1]:
                    continue
            if now is not None:
                yield from _closed(now, False, min_docs)
            elif len(cuts):  # the partition's first run, which ends in this batch
                now = _Open(True, rows)
                if (out := now.add(rows[:, :cuts[0]], min_docs)) is not None:
                    yield _columns(DROP, out)
                yield from _closed(now, False, min_docs)
                rows, cuts = rows[:, cuts[0]:], cuts[1:] - cuts[0]
                started = True
            started = started or now is not None
            last = cuts[-1] if len(cuts) else 0
            if last:
                inside = rows[:, :last]
                starts = np.concatenate([[0], cuts[:-1]])
                new = np.ones(last, "int64")
                new[1:] = np.any(inside[:4, 1:] != inside[:4, :-1], axis=0)
                many = np.add.reduceat(new, starts) >= min_docs
                if many.any():
                    yield _columns(DROP, inside[:, np.repeat(many, np.diff([*starts, last]))])
            now = _Open(not started, rows[:, last:])
            started = True
            if (out := now.add(rows[:, last:], min_docs)) is not None:
                yield _columns(DROP, out)
        if now is not None:
            yield from _closed(now, True, min_docs)
    return run


@F.pandas_udf(BinaryType())
def _bitmap(positions: pd.Series) -> pd.Series:
    """Compressed bits, 1 for each line kept, up to the byte of the last line dropped; later lines are all kept."""
    def packed(at):
        bits = np.ones(8 * (int(at.max()) // 8 + 1), bool)
        bits[at] = False
        return zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)
    return positions.map(packed)


def keep_bits(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    """Which of ``n_lines`` lines stay, from a document's bitmap (none: all)."""
    keep = np.ones(n_lines, bool)
    if bitmap is not None:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), "uint8"), bitorder="little")[:n_lines]
        keep[:len(bits)] = bits.astype(bool)
    return keep


def keep_bitmaps(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """(doc, body, n_dropped, bitmap) of each document that loses lines.

    ``docs`` is (doc_id, text) as ``base.texts`` gives it.  A line goes if its key stands in ``min_docs`` documents or
    more; with ``keep_first`` its first occurrence (lowest document, then position) stays.  A document is an id with a
    text: rows that repeat both count once.
    """
    dealt = line_hashes(docs).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    marks = base.written(spark, base.arrow_map(dealt, _stream(min_docs), MARKS), "line-marks")
    # a run over several partitions: a document at the seam of two counts once
    seam = Window.partitionBy("h1", "h2").orderBy("doc", "body", "pos")
    runs = (marks.filter(F.col("kind") == RUN)
            .withColumn("n", F.col("n") - F.when((F.lag("last_doc").over(seam) == F.col("doc"))
                                                 & (F.lag("last_body").over(seam) == F.col("body")), 1).otherwise(0))
            .groupBy("h1", "h2").agg(F.sum("n").alias("n_docs")).filter(F.col("n_docs") >= min_docs))
    kept_back = marks.filter(F.col("kind") == OPEN).join(runs, ["h1", "h2"], "left_semi")
    dropped = marks.filter(F.col("kind") == DROP).unionByName(kept_back)
    if keep_first:
        heads = dropped.groupBy("h1", "h2").agg(F.min(F.struct("doc", "body", "pos")).alias("head"))
        dropped = dropped.join(heads, ["h1", "h2"]).filter(F.struct("doc", "body", "pos") != F.col("head"))
    return (dropped.groupBy("doc", "body").agg(F.collect_set("pos").alias("at"))
            .select("doc", "body", F.size("at").cast("bigint").alias("n_dropped"),
                    _bitmap("at").alias("bitmap")))


def _with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    return _identified(docs).join(bitmaps, ["doc", "body"], "left")


def _kept_text(text: str, bitmap: bytes | None) -> tuple[str, int]:
    if bitmap is None:
        return text, text.count("\n") + 1
    lines = text.split("\n")
    keep = keep_bits(bitmap, len(lines))
    return "\n".join(line for line, k in zip(lines, keep, strict=True) if k), len(lines)


def drop_lines(spark: SparkSession, docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every row of ``docs`` with what is left of its text.  A null or empty text
    is one empty line, which stays; a text that loses all its lines becomes empty."""
    return _applied(spark, docs, min_docs, keep_first, "text string", lambda text: {"text": text})


def _applied(spark, docs, min_docs, keep_first, column: str, value) -> DataFrame:
    docs = base.texts(docs)

    def fn(batches):
        for batch in batches:
            for part in base.slices(batch, 8 << 20):
                cols = {"doc_id": part.column("doc_id"), "n_lines": [], "n_dropped": part.column("n_dropped")}
                for text, bitmap in zip(part.column("text").to_pylist(), part.column("bitmap").to_pylist(), strict=True):
                    kept, n = _kept_text(text, bitmap)
                    cols["n_lines"].append(n)
                    for k, v in value(kept).items():
                        cols.setdefault(k, []).append(v)
                yield cols

    joined = _with_bitmaps(docs, keep_bitmaps(spark, docs, min_docs, keep_first)).select(
        "doc_id", "text", "bitmap", F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"))
    return base.arrow_map(joined, fn, f"doc_id bigint, n_lines bigint, n_dropped bigint, {column}")


SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM lines),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common USING (key) GROUP BY doc_id"""


@base.register("op13_line_dedup", SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, base.table(spark, sf_dir, "documents"), MIN_DOCS, False, "kept_sha256 string",
                    lambda text: {"kept_sha256": hashlib.sha256(text.encode()).hexdigest()})

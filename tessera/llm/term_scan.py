"""Operator 12: ranked lexical search by scanning the documents with an Aho-Corasick automaton of the items' terms.

There is no index of the documents.  Each text is cut down to lower-case terms with one blank for every other
character, and the automaton holds each term between two blanks, so it reports whole terms only.  One scan counts
the documents, their terms and the document frequencies of the items' terms; a second counts each text's term
frequencies anew, maps them to the items and keeps the best documents of each item and task.  Nothing but counts and
those best rows is shuffled.

Items come in blocks of at most ``BLOCK_BYTES`` of text (or one item), each scanned for on its own, so what is sent to
the tasks is bounded however many items there are.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from operator import itemgetter
from uuid import uuid4

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import base

#: A maximal run of these is a term: letters and digits of ASCII and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 20
BLOCK_BYTES = 4 << 20
#: A text is scanned in pieces of about this many bytes, cut between terms.
PIECE = 1 << 20
#: Cells of the table (documents of a chunk x items) filled at a time, and documents of a chunk.
CELLS, CHUNK = 2_000_000, 1024
_LETTERS = (string.ascii_letters + string.digits).encode()
#: Bytes of a text -> bytes of its terms and blanks.
BLANKED = bytes(b if b >= 0x80 else bytes([b]).lower()[0] if b in _LETTERS else 0x20 for b in range(256))


def terms_of(text: str) -> list[str]:
    return [t.decode() for t in text.encode().translate(BLANKED).split(b" ") if t]


def _pieces(text: bytes):
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE) if at + PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


class Automaton:
    """Counts the terms of a text, all of them and those it knows."""

    def __init__(self, terms: list[str]):
        self.found = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.found.add_word(f" {term} ", i)
        self.found.make_automaton()

    def count(self, text: bytes) -> tuple[int, dict[int, int]]:
        n, known = 0, Counter()
        for piece in _pieces(text.translate(BLANKED)):
            n += len(piece.split())  # blanks are the only white space left in bytes
            if len(self.found):
                known.update(map(itemgetter(1), self.found.iter(f" {piece.decode('utf-8', 'replace')} ")))
        return n, known


def _texts(batches):
    """(ids, texts as bytes) of slices of the batches; a null text is empty."""
    for batch in batches:
        for part in base.slices(batch, 8 << 20):
            yield part.column("doc_id").to_pylist(), [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]


def _frequencies(docs: DataFrame, key: str, terms: list[str]) -> tuple[int, int, list[int]]:
    """Documents with terms, all their terms, and the document frequency of each of ``terms``."""
    def fn(batches):
        automaton = base.kept(key, lambda: Automaton(terms))
        counts = np.zeros(len(terms) + 2, "int64")
        for _, texts in _texts(batches):
            for text in texts:
                n, known = automaton.count(text)
                counts[:2] += (n > 0, n)
                if known:
                    counts[np.fromiter(known, "int64", len(known)) + 2] += 1
        at = np.flatnonzero(counts)
        yield {"slot": at, "n": counts[at]}

    total = dict(base.arrow_map(docs, fn, "slot int, n bigint").groupBy("slot").agg(F.sum("n")).collect())
    return total.get(0, 0), total.get(1, 0), [total.get(i + 2, 0) for i in range(len(terms))]


def _weights(n_docs: int, df: list[int]) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df]


class _Best:
    """The best rows of each item so far: score, document, by score down, then document (null last)."""

    def __init__(self, items: int, top: int):
        self.top, self.least = top, np.ones(items, "int64")
        self.item, self.score, self.doc, self.null = (np.zeros(0, t) for t in ("int64", "int64", "int64", bool))

    def add(self, item, score, doc, null):
        self.item, self.score, self.doc, self.null = (np.concatenate(p) for p in (
            (self.item, item), (self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((self.doc, self.null, -self.score, self.item))
        sorted_item = self.item[order]
        starts = np.flatnonzero(np.r_[True, sorted_item[1:] != sorted_item[:-1]]) if len(order) else np.zeros(0, "int64")
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
        order = order[place < self.top]
        self.item, self.score, self.doc, self.null = (a[order] for a in (self.item, self.score, self.doc, self.null))
        full = np.bincount(self.item, minlength=len(self.least)) == self.top
        worst = np.full(len(self.least), np.iinfo("int64").max)
        np.minimum.at(worst, self.item, self.score)
        self.least[full] = worst[full]


def _scored(docs: DataFrame, key: str, terms: list[str], weights: list[int], postings, n_items: int, n_docs: int,
            n_terms: int, top: int) -> DataFrame:
    """(item, score, doc_id) of each task's best documents of each item."""
    first, items, times = postings

    def fn(batches):
        automaton = base.kept(key, lambda: Automaton(terms))
        w = np.array(weights, "int64")
        best = _Best(n_items, top)
        chunk = max(1, min(CHUNK, CELLS // max(1, n_items)))
        for ids, texts in _texts(batches):
            for at in range(0, len(texts), chunk):
                row, term, tf, length = [], [], [], []
                for i, text in enumerate(texts[at:at + chunk]):
                    n, known = automaton.count(text)
                    m = 75 + (25 * n * n_docs) // n_terms if known else 0
                    row += [i] * len(known)
                    term += known.keys()
                    tf += known.values()
                    length += [m] * len(known)
                if not row:
                    continue
                row, term, tf, length = (np.array(x, "int64") for x in (row, term, tf, length))
                part = w[term] * (1_000_000_000 * tf // (1000 * tf + 12 * length))
                cells = np.zeros((min(chunk, len(texts) - at), n_items), "int64")
                # each hit stands for all items with its term, taken in runs so that memory stays bounded
                many = first[term + 1] - first[term]
                for lo, hi in _runs(many, CELLS):
                    k = many[lo:hi]
                    slot = np.repeat(first[term[lo:hi]] - np.r_[0, np.cumsum(k)[:-1]], k) + np.arange(k.sum())
                    np.add.at(cells, (np.repeat(row[lo:hi], k), items[slot]), np.repeat(part[lo:hi], k) * times[slot])
                r, item = np.nonzero(cells >= best.least)
                null = np.array([ids[at + j] is None for j in r], bool)
                doc = np.array([ids[at + j] or 0 for j in r], "int64")
                best.add(item, cells[r, item], doc, null)
        yield {"item": best.item, "score": best.score, "doc_id": pa.array(best.doc, mask=best.null)}

    return base.arrow_map(docs, fn, "item int, score bigint, doc_id bigint")


def _runs(sizes: np.ndarray, limit: int):
    """Consecutive index ranges whose sizes add up to about ``limit`` (one index at least)."""
    block = np.cumsum(sizes) // limit
    cuts = np.r_[0, np.flatnonzero(block[1:] != block[:-1]) + 1, len(sizes)]
    return zip(cuts[:-1], cuts[1:], strict=True)


def _blocks(items: DataFrame, block_bytes: int):
    """Distinct items, block by block, as rows (item_id, text)."""
    sized = items.withColumn("_bytes", F.octet_length("text"))
    total = sized.agg(F.sum("_bytes")).first()[0] or 0
    n = max(1, math.ceil(2 * total / block_bytes))
    while True:
        dealt = sized.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
        worst = dealt.groupBy("_block").agg(F.sum("_bytes").alias("b"), F.count("*").alias("n")).filter(
            (F.col("b") > block_bytes) & (F.col("n") > 1)).limit(1).count()
        if not worst:
            break
        n *= 2
    for b in range(n):
        rows = dealt.filter(F.col("_block") == b).select("item_id", "text").collect()
        if rows:
            yield sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0, r.text))


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, top: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item, with a score above 0.

    ``docs`` (doc_id, text), ``items`` (item_id, text); other columns are left behind.  Null and empty texts have no
    terms.  Every document row is a document, repeated rows too; among equal scores null ids come last.  An item is an
    id with a text: repeated item rows count once, and each text of a repeated id is ranked for itself.  An empty table
    of either kind gives no rows.
    """
    docs = base.texts(docs)
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce(
        F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    out = None
    for rows in _blocks(items, block_bytes):
        found = _search_block(spark, docs, rows, top)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


def _search_block(spark: SparkSession, docs: DataFrame, rows: list, top: int) -> DataFrame:
    held = [Counter(terms_of(r.text)) for r in rows]
    terms = sorted(set().union(*held))
    number = {t: i for i, t in enumerate(terms)}
    entries = sorted((number[t], i, k) for i, c in enumerate(held) for t, k in c.items())
    first = np.searchsorted(np.array([e[0] for e in entries], "int64"), np.arange(len(terms) + 1))
    postings = (first, np.array([e[1] for e in entries], "int64"), np.array([e[2] for e in entries], "int64"))
    key = f"term-scan-{uuid4().hex}"
    n_docs, n_terms, df = _frequencies(docs, key, terms)
    scored = base.written(spark, _scored(docs, key, terms, _weights(n_docs, df), postings, len(rows), n_docs, n_terms,
                                         top).withColumn("part", F.spark_partition_id() % 64), "term-scan")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for by in (["item", "part"], ["item"]):  # in two steps: one item's rows grow with the number of tasks
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(
            F.col("rank") <= top)
    names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(rows)], "item int, item_id bigint")
    return scored.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")  # a block of items


SQL = rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                 '{TERM}')) AS term FROM documents),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT item_id, term, count(*) AS times FROM (
  SELECT item_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                         '{TERM}')) AS term FROM benchmark) GROUP BY item_id, term),
s AS (SELECT item_id, doc_id, sum(times * floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
        * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN df USING (term) JOIN tf USING (term) JOIN d USING (doc_id) CROSS JOIN c GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= {TOP}"""


@base.register("op12_term_scan", SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, base.table(spark, sf_dir, "documents"), base.table(spark, sf_dir, "benchmark"))

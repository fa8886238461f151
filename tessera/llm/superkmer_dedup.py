"""Operator 7: exact substring dedup by super-k-mer partitioning over words.

A window is ``window`` consecutive words of a text.  Its minimiser is the least hash of the ``mer`` words long
sequences inside it; consecutive windows of a text with one minimiser form a super-k-mer, which travels as one
packed string to the bucket of its minimiser.  Equal windows have equal minimisers, so they meet in one bucket, and
sorting the windows of a minimiser there finds the repeated ones exactly, by their words.

What keeps it bounded:

* Texts are hashed in short stretches; strings travel in one compressed block per bucket and slice of input.  A string that comes twice in a slice is
  sent once, marked as repeated; its places are known to be repeated at once.
* Sequences found in at least 1 % of a bounded sample of documents are used as minimisers only for windows that
  have no other (as k-mer counters avoid frequent k-mers), so a line or passage that a third of all documents share
  does not gather their different surroundings in one bucket.  The order of minimisers changes where windows meet,
  never what is found.
* Buckets go by number to their partition; a task holds one bucket at a time.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base

WINDOW_WORDS = 35
MER_WORDS = 6
SAMPLE_DOCS = 4000
SAMPLE_SHARE = 0.01
SLICE_BYTES = 3_000_000
#: Text hashed at once: the arrays for it take about 80 bytes a byte.
STRETCH_BYTES = 400_000
#: A task's buckets are solved one after the other; more of them take less memory and compress less.
BUCKETS_PER_TASK = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(1 << 63)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse, ``n`` at least."""
    held = base.kept("op7", list)
    if not held or len(held[0]) < n:
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        held[:] = [np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, x, np.uint64))]) for x in (_ODD, inverse)]
    return held[0], held[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _spans_hash(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of values[lo:hi] per span, from one running sum."""
    power, inverse = _powers(len(values))
    total = np.concatenate([[np.uint64(0)], np.cumsum(values * power[:len(values)])])
    return _mix((total[hi] - total[lo]) * inverse[lo])


class Slice:
    """Words and minimisers of a run of texts."""

    def __init__(self, texts: list[str], window: int, mer: int, frequent: np.ndarray | None):
        lines = [b" ".join(t.encode().split()) for t in texts]
        counts = np.array([x.count(b" ") + 1 if x else 0 for x in lines], np.int64)
        self.data = b" ".join([x for x in lines if x]) + b" "
        flat = np.frombuffer(self.data, np.uint8)
        self.stop = np.flatnonzero(flat == 32) if counts.any() else np.zeros(0, np.int64)
        self.start = np.concatenate([[0], self.stop[:-1] + 1]) if len(self.stop) else self.stop
        self.first = np.concatenate([[0], np.cumsum(counts)])  # number of each text's first word
        self.text_of = np.repeat(np.arange(len(lines)), counts)
        self.counts, self.window, self.mer = counts, window, mer
        n = len(self.stop)
        self.mers = np.zeros(0, np.uint64)
        if n >= mer:
            words = _spans_hash(flat.astype(np.uint64) + np.uint64(1), self.start, self.stop)
            at = np.arange(n - mer + 1)
            self.mers = _spans_hash(words, at, at + mer) & ~_TOP
            if frequent is not None and len(frequent):
                self.mers[np.isin(self.mers, frequent)] |= _TOP

    def super_kmers(self):
        """(minimiser, first window's word, last window's word, holds its minimiser more than once) per run."""
        w, per = self.window, self.window - self.mer + 1
        n = len(self.stop) - w + 1
        if n <= 0:
            return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2, np.zeros(0, bool))
        least, span = self.mers, 1
        while span < per:
            step = min(span, per - span)
            least = np.minimum(least[:-step], least[step:])
            span += step
        valid = np.flatnonzero(self.text_of[:n] == self.text_of[w - 1:])
        if not len(valid):
            return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2, np.zeros(0, bool))
        value = least[valid]
        new = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (valid[1:] != valid[:-1] + 1)
                                             | (self.text_of[valid[1:]] != self.text_of[valid[:-1]])]))
        a, b, value = valid[new], valid[np.append(new[1:], len(valid)) - 1], value[new]
        size = b - a + per  # sequences in each run
        ends = np.cumsum(size)
        inside = np.repeat(a - (ends - size), size) + np.arange(ends[-1])
        same = np.add.reduceat((self.mers[inside] == np.repeat(value, size)).astype(np.int32), ends - size)
        return value, a, b, same > 1


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _runs(cut: Slice, before: int, strings: list[bytes]):
    """Per super-k-mer: minimiser, number of its text (``before`` texts came earlier), its first word there, number of
    windows, whether it holds its minimiser more than once; its words go to ``strings``."""
    value, a, b, twice = cut.super_kmers()
    text = cut.text_of[a]
    strings += [cut.data[x:y] for x, y in zip(cut.start[a].tolist(), cut.stop[b + cut.window - 1].tolist())]
    return value, text + before, a - cut.first[text], b - a + 1, twice


def _blocks(n_buckets: int, window: int, mer: int, frequent):
    """Arrow function: (id, key, text) -> (bucket, block)."""
    def run(batches):
        pack = zstandard.ZstdCompressor(level=5).compress
        seen = None if frequent is None else np.array(frequent.value, np.uint64)
        for batch in batches:
            for part in base.slices(batch, SLICE_BYTES):
                ids = part.column("id").to_numpy()
                keys = part.column("key").to_numpy()
                strings, runs, before = [], [], 0
                for stretch in base.slices(part, STRETCH_BYTES):
                    runs.append(_runs(Slice(stretch.column("text").to_pylist(), window, mer, seen), before, strings))
                    before += stretch.num_rows
                value, text, word, n_windows, twice = (np.concatenate(x) for x in zip(*runs))
                if not len(value):
                    continue
                place: dict[bytes, int] = {}
                times = np.zeros(len(value), np.int64)
                firsts = np.array([place.setdefault(s, i) for i, s in enumerate(strings)])
                np.add.at(times, firsts, 1)
                again = times[firsts] > 1
                bucket = (_mix(value) % np.uint64(n_buckets)).astype(np.int64)
                sent = np.flatnonzero(firsts == np.arange(len(firsts)))
                sent = sent[np.argsort(bucket[sent], kind="stable")]
                numbers, counts = np.unique(bucket[sent], return_counts=True)
                out, at = [], 0
                for n in counts.tolist():
                    own = sent[at:at + n]
                    at += n
                    head = np.array([n], np.int64).tobytes() + b"".join(
                        x.tobytes() for x in (value[own], ids[text[own]], keys[text[own]], word[own],
                                              (times[own] > 1) + 2 * twice[own]))
                    out.append(pack(head + b"\n".join([strings[i] for i in own.tolist()])))
                rows = {"bucket": numbers.tolist(), "block": out, "id": [None] * len(out), "key": [None] * len(out),
                        "a": [None] * len(out), "b": [None] * len(out)}
                spans: dict[int, list] = {}
                for i in np.flatnonzero(again).tolist():
                    spans.setdefault(int(text[i]), []).append((int(word[i]), int(word[i] + n_windows[i] + window - 1)))
                for t, own in spans.items():
                    for x, y in _merge(own):
                        for c, v in zip(rows, (int(keys[t] % n_buckets), None, int(ids[t]), int(keys[t]), x, y)):
                            rows[c].append(v)
                yield rows

    return run


def _repeated(window: int):
    """Arrow function: blocks sorted by bucket -> (id, key, a, b): words covered by a repeated window."""
    def solve(blocks):
        unpack = zstandard.ZstdDecompressor().decompress
        heads, strings = [], []
        for block in blocks:
            raw = unpack(block)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            heads.append(np.frombuffer(raw, "<i8", 5 * n, 8).reshape(5, n).copy())  # a view would keep all of raw
            strings.append(raw[8 + 40 * n:])
        lengths = [h.shape[1] for h in heads]
        value, ids, keys, word, flag = np.concatenate(heads, axis=1)
        value = value.view(np.uint64)
        del heads, raw
        order = np.argsort(value, kind="stable")
        sorted_value = value[order]
        starts = np.flatnonzero(np.concatenate([[True], sorted_value[1:] != sorted_value[:-1]]))
        sizes = np.diff(np.append(starts, len(order)))
        wanted = np.zeros(len(value), bool)
        wanted[order] = np.repeat(sizes > 1, sizes)
        wanted |= flag > 1
        if not wanted.any():
            return None
        own: dict[int, bytes] = {}  # strings of the minimisers that matter
        at = 0
        for block, n in zip(strings, lengths):
            pick = np.flatnonzero(wanted[at:at + n]).tolist()
            if pick:
                lines = block.split(b"\n")
                own.update((at + i, lines[i]) for i in pick)
            at += n
        del strings
        cols: dict[str, list] = {"id": [], "key": [], "a": [], "b": []}

        def hit(i, a, b):
            for c, v in zip(cols.values(), (ids[i], keys[i], a, b)):
                c.append(int(v))

        for lo, size in zip(starts.tolist(), sizes.tolist()):
            members = [i for i in order[lo:lo + size].tolist() if wanted[i]]
            if not members:
                continue
            groups: dict[bytes, list[int]] = {}
            for i in members:
                groups.setdefault(own[i], []).append(i)
            windows, spaces = [], {}
            if len(groups) > 1 or flag[members].max() > 1:
                for s, (string, places) in enumerate(groups.items()):
                    stops = np.flatnonzero(np.frombuffer(string, np.uint8) == 32).tolist()
                    begins, stops = [0, *(x + 1 for x in stops)], [*stops, len(string)]
                    windows += [(string[x:y], s, o) for o, (x, y) in enumerate(zip(begins, stops[window - 1:]))]
                windows.sort()
            for _, same in groupby(windows, key=lambda x: x[0]):
                same = list(same)
                if len(same) > 1:
                    for _, s, o in same:
                        spaces.setdefault(s, []).append((o, o + window))
            for s, (string, places) in enumerate(groups.items()):
                sent = [i for i in places if not flag[i] & 1]  # the others' places are known since the first pass
                if len(places) > 1 or len(sent) < len(places):
                    spans = [(0, string.count(b" ") + 1)]
                else:
                    spans = _merge(spaces.get(s, []))
                whole = any(flag[i] & 1 for i in places) or len(places) > 1
                for i in places:
                    if whole and flag[i] & 1:
                        continue
                    for a, b in spans:
                        hit(i, word[i] + a, word[i] + b)
        return cols if cols["id"] else None

    def run(batches):
        now, held = None, []
        for batch in batches:
            buckets = batch.column("bucket").to_pylist()
            blocks = batch.column("block")
            passed = batch.filter(pc.is_null(blocks))
            if passed.num_rows:
                yield {c: passed.column(c) for c in ("id", "key", "a", "b")}
            for i, n in enumerate(buckets):
                if not blocks[i].is_valid:
                    continue
                if n != now:
                    if held and (found := solve(held)):
                        yield found
                    now, held = n, []
                held.append(blocks[i].as_py())
        if held and (found := solve(held)):
            yield found

    return run


def _frequent(spark: SparkSession, rows: DataFrame, window: int, mer: int, sample_docs: int):
    """Hashes of the sequences that at least 1 % of a sample of about ``sample_docs`` texts hold, as a broadcast
    (at most 100 times the sample's texts' mean length)."""
    n = rows.count()
    part = rows.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(min(1.0, sample_docs / max(n, 1)) * (1 << 20)))

    def run(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                mers = np.unique(Slice([text], window, mer, None).mers)
                yield {"mer": pa.array(mers.view(np.int64))}

    found = base.arrow_map(part.select("text"), run, "mer bigint").groupBy("mer").count()
    least = max(8, int(min(n, sample_docs) * SAMPLE_SHARE))
    return spark.sparkContext.broadcast(np.array([r[0] for r in found.filter(F.col("count") >= least).select("mer").collect()],
                                                 np.int64).view(np.uint64))


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with (_id, _key): equal for repeated rows only (an id of null counts as -1 and keeps its own key)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)),
                             "_key": F.xxhash64(text, F.col("doc_id").cast("bigint"))})


def repeated_spans(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS, mer: int = MER_WORDS,
                   sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(_id, _key, spans): per text the spans of words that a repeated window covers, as one array of starts and
    ends in turn; texts without are left out."""
    rows = _keyed(docs).select(F.col("_id").alias("id"), F.col("_key").alias("key"),
                               F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    frequent = _frequent(spark, rows, window, mer, sample_docs)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = base.arrow_map(rows, _blocks(BUCKETS_PER_TASK * n, window, mer, frequent),
                            "bucket int, block binary, id bigint, key bigint, a int, b int")
    met = blocks.repartitionById(n, F.pmod("bucket", F.lit(n))).sortWithinPartitions("bucket")
    hits = base.arrow_map(met, _repeated(window), "id bigint, key bigint, a int, b int")
    return (hits.groupBy(F.col("id").alias("_id"), F.col("key").alias("_key"))
            .agg(F.flatten(F.collect_set(F.array("a", "b"))).alias("spans")))


def kept_words(words: list[bytes], spans) -> list[bytes]:
    kept, at = [], 0
    for a, b in _merge(list(zip(spans[::2], spans[1::2]))) if spans is not None else ():
        kept += words[at:a]
        at = b
    return kept + words[at:]


def _with_spans(spark, docs, window):
    spans = base.written(spark, repeated_spans(spark, docs, window), "spans")
    return _keyed(docs).join(spans, ["_id", "_key"], "left")


def report(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (kept words joined by one space).

    A word goes if a window covers it whose words also start anywhere else, in another text or the same.  Windows
    are judged on the input.  Null and empty texts have no words; a text shorter than a window keeps all; repeated
    rows are texts of their own, so both lose what they share; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            n, removed, digest = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                kept = kept_words(words, spans)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield {"doc_id": batch.column("doc_id"), "n_words": n, "n_removed": removed, "kept_sha256": digest}

    joined = _with_spans(spark, docs.select("doc_id", "text"), window).select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                                     F.col("text").cast("string").alias("text"), "spans")
    return base.arrow_map(joined, run, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")


def remove_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """docs with the repeated words taken out of ``text`` (what is kept is joined by one space; a text that loses
    nothing stays as it is, null too) and ``n_chars``, if there, counted anew."""
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if s is None else b" ".join(kept_words(t.encode().split(), s)).decode()
                          for t, s in zip(text, spans)], dtype=object)

    def stage(frame):
        out = _with_spans(spark, frame, window).withColumn("text", cut(F.col("text").cast("string"), "spans"))
        if "n_chars" in frame.columns:
            out = out.withColumn("n_chars", F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(
                F.length("text").cast(frame.schema["n_chars"].dataType)))
        return out

    return base.shielded(docs, stage)


@base.register("op7_superkmer_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spark, base.table(spark, sf_dir, "documents"))

"""Operator 3: SimHash near-duplicates by a binary trie self-join.

Fingerprints are reduced to the distinct ones first, so exact copies cost nothing more.  Two fingerprints within
``max_bits`` differing bits agree on at least one of ``max_bits + 1`` bit blocks, so each goes to one shard per
block, keyed by the block's value.  Within a shard a binary trie of the fingerprints is joined with itself: node
pairs go down together, the bits they differ in add up, and a pair ends where they exceed the budget.  A pair whose
leaves are already known to be connected ends too, so a dense group of near copies isn't expanded into all its
pairs; a shard gives a spanning forest of its links.  Components of all forests follow by star contraction.

A shard with more fingerprints than a task should have (near copies agree on whole blocks) is dealt again by pairs
of trie nodes: see ``_deal``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base
from .components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: Node pairs taken down one level at a time; bounds a task's memory.
PAIRS_AT_ONCE = 400_000


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 hashes."""
    parts = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space separates
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts]).tolist()
    stops = (ends - 1).tolist()
    last = max(len(parts) - words + 1, 1)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, last, 65536):
        hashes = np.array([digest(line[a:b], seed) for a, b in
                           zip(starts[at:min(at + 65536, last)], stops[min(words, len(parts)) - 1 + at:])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int32)
    return int(np.packbits(2 * counts > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, text_hash, fp) per row; fp is the fingerprint as a signed 64-bit number."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t or "", words, seed) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                   "fp": pa.array(np.array(fps, np.uint64).view(np.int64))}

    return base.arrow_map(base.texts(docs).withColumn("text_hash", F.xxhash64("text")), run,
                          "doc_id bigint, text_hash bigint, fp bigint")


class Trie:
    """Binary trie over a sorted array of distinct fingerprints: a node is a range of it."""

    def __init__(self, fps: np.ndarray, budget: int):
        self.fps, self.budget = fps, budget
        self.ones: dict[int, np.ndarray] = {}
        self.label = np.arange(len(fps))
        self._mark_runs()

    def _mark_runs(self):
        self.runs = np.concatenate([[0], np.cumsum(self.label[1:] != self.label[:-1])])

    def _split(self, bit, lo, hi):
        """First index whose ``bit`` is 1, per node."""
        if bit not in self.ones:
            self.ones[bit] = np.concatenate([[0], np.cumsum((self.fps >> np.uint64(bit) & np.uint64(1)).astype(np.int32))])
        ones = self.ones[bit]
        return hi - (ones[hi] - ones[lo])

    def join(self, a_lo, a_hi, b_lo, b_hi) -> np.ndarray:
        """Links the leaves of each node pair (equal ranges: a node with itself) and returns the labels: the
        smallest index of each leaf's component."""
        stack = [(63, a_lo, a_hi, b_lo, b_hi, np.zeros(len(a_lo), np.int8))]
        while stack:
            bit, al, ah, bl, bh, err = stack.pop()
            if len(al) > PAIRS_AT_ONCE:
                h = len(al) // 2
                stack += [(bit, *(x[h:] for x in (al, ah, bl, bh, err))), (bit, *(x[:h] for x in (al, ah, bl, bh, err)))]
                continue
            keep = ~((self.runs[ah - 1] == self.runs[al]) & (self.runs[bh - 1] == self.runs[bl])
                     & (self.label[al] == self.label[bl]))
            leaf = keep & (ah - al == 1) & (bh - bl == 1)
            if leaf.any():
                a, b = al[leaf], bl[leaf]
                near = np.bitwise_count(self.fps[a] ^ self.fps[b]) <= self.budget
                self._unite(a[near], b[near])
            keep &= ~leaf
            if bit < 0 or not keep.any():
                continue
            al, ah, bl, bh, err = (x[keep] for x in (al, ah, bl, bh, err))
            am, bm = self._split(bit, al, ah), self._split(bit, bl, bh)
            cross = al != bl  # a node with itself has no mirrored pair
            parts = [(al, am, bl, bm, err), (am, ah, bm, bh, err), (al, am, bm, bh, err + 1),
                     tuple(x[cross] for x in (am, ah, bl, bm, err + 1))]
            al, ah, bl, bh, err = (np.concatenate(x) for x in zip(*parts))
            keep = (ah > al) & (bh > bl) & (err <= self.budget) & ~((al == bl) & (ah - al == 1))
            if keep.any():
                stack.append((bit - 1, *(x[keep] for x in (al, ah, bl, bh, err))))
        return self.label

    def _unite(self, a, b):
        while len(a):
            la, lb = self.label[a], self.label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            up = np.arange(len(self.label))
            np.minimum.at(up, np.maximum(la, lb), np.minimum(la, lb))
            while not np.array_equal(higher := up[up], up):
                up = higher
            self.label = up[self.label]
            self._mark_runs()


def _deal(fps: DataFrame, max_bits: int, shard_rows: int) -> DataFrame:
    """(shard, p, q, side, fp): every fingerprint once per bit block; shards above ``shard_rows`` are dealt again.

    There are at most ``max_bits + 1`` times 2**width shards, whatever the input, so their counts are a table of
    bounded size.  A large shard's fingerprints go to trie nodes p of its next bits and from there to every pair
    of nodes within the budget (p = q: the node with itself), so no pair of fingerprints is lost.
    """
    blocks = max_bits + 1
    width = min(64 // blocks, 16)
    value = "shiftrightunsigned(fp, cast(block * {0} as int)) & {1}L".format(64 // blocks, (1 << width) - 1)
    dealt = (fps.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max_bits))))
             .withColumn("shard", F.expr(f"cast(block as bigint) << {width} | ({value})")))
    rows = dealt.groupBy("shard").count().filter(F.col("count") > shard_rows)
    large = rows.withColumn("bits", F.least(F.ceil(F.log2(4 * F.col("count") / shard_rows)), F.lit(10)).cast("int"))
    next_bits = f"cast(shiftrightunsigned(fp, cast((block * {64 // blocks} + {width}) % 54 as int)) & ((1L << bits) - 1) as int)"
    split = (dealt.join(large, "shard", "left").withColumn("node", F.when(F.col("bits").isNull(), 0).otherwise(F.expr(next_bits)))
             .withColumn("other", F.explode(F.when(F.col("bits").isNull(), F.array(F.lit(0))).otherwise(F.expr(
                 f"filter(sequence(0, cast((1L << bits) - 1 as int)), x -> bit_count(x ^ node) <= {max_bits})")))))
    return split.select("shard", F.least("node", "other").alias("p"), F.greatest("node", "other").alias("q"),
                        (F.col("node") > F.col("other")).cast("int").alias("side"), "fp")


def _join_shards(max_bits: int, rows_at_once: int):
    """Arrow function: rows sorted by (shard, p, q) -> links (a, b) of each shard's spanning forest."""
    def links(keys, side, fp):
        group = np.concatenate([[0], np.cumsum((keys[1:] != keys[:-1]).any(axis=1))])
        part = 2 * group + side
        order = np.lexsort((fp, part))
        part, fp = part[order], fp[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        stops = np.append(starts[1:], len(part))
        kind = part[starts]
        crossed = keys[order][starts, 1] != keys[order][starts, 2]
        alone = ~crossed & (stops - starts > 1)
        pair = np.flatnonzero(crossed[:-1] & (kind[:-1] % 2 == 0) & (kind[1:] == kind[:-1] + 1))
        lo, hi = np.concatenate([starts[alone], starts[pair]]), np.concatenate([stops[alone], stops[pair]])
        lo2, hi2 = np.concatenate([starts[alone], starts[pair + 1]]), np.concatenate([stops[alone], stops[pair + 1]])
        if not len(lo):
            return None
        label = Trie(fp, max_bits).join(lo, hi, lo2, hi2)
        child = np.flatnonzero(label != np.arange(len(label)))
        return {"a": fp[label[child]].view(np.int64), "b": fp[child].view(np.int64)}

    def run(batches):
        held = None
        for batch in batches:
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "p", "q", "side", "fp")]
            keys, side, fp = np.column_stack(cols[:3]), cols[3], cols[4].view(np.uint64)
            if held is not None:
                keys, side, fp = (np.concatenate(x) for x in zip(held, (keys, side, fp)))
            cut = 0
            if len(fp) >= rows_at_once:
                new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))
                cut = int(new[-1]) + 1 if len(new) else 0
            if cut and (found := links(keys[:cut], side[:cut], fp[:cut])):
                yield found
            held = keys[cut:], side[cut:], fp[cut:]
        if held is not None and len(held[2]) and (found := links(*held)):
            yield found

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, shard_rows: int = 50_000) -> DataFrame:
    """fps: distinct (fp bigint).  Links (a, b) that connect exactly the fingerprints which chains of links within
    ``max_bits`` connect (0 to 7)."""
    dealt = _deal(fps, max_bits, shard_rows).repartition("shard", "p", "q").sortWithinPartitions("shard", "p", "q")
    return base.arrow_map(dealt, _join_shards(max_bits, 100_000), "a bigint, b bigint")


def _grouped(spark: SparkSession, docs: DataFrame, words: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) per row, and (fp, component_id, doc_id, text_hash) per distinct fingerprint: the
    component's smallest doc_id, and the row that stands for the component."""
    rows = base.written(spark, fingerprints(docs, words), "simhash")
    distinct = base.written(spark, rows.groupBy("fp").agg(
        F.min("doc_id").alias("first"),
        F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_hash"))).alias("row")), "simhash-distinct")
    joined = connected_components(spark, fingerprint_links(distinct.select("fp"), max_bits))
    linked = distinct.join(joined, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    best = linked.groupBy("root").agg(F.min("first").alias("component_id"), F.min("row").alias("row"))
    members = base.written(spark, linked.select("fp", "root").join(best, "root").select(
        "fp", "component_id", F.col("row.doc_id").alias("kept_id"), F.col("row.text_hash").alias("kept_hash")),
        "simhash-members")
    return rows, members


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links of at most
    ``max_bits`` differing bits, itself included).

    Null and empty texts, and texts of white space, have fingerprint zero and link like any other.  A text of
    fewer words than a shingle is one shingle.  Null ids never are a component's smallest unless it has no other:
    then component_id is null.  Repeated rows stay rows; an empty table gives no rows.
    """
    rows, members = _grouped(spark, docs, words, max_bits)
    return rows.join(members, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                           "component_id")


def keep_one(spark: SparkSession, docs: DataFrame, words: int = SHINGLE_WORDS,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stand for their component, one each (smallest doc_id, null ids last; of rows with
    the same id and text one), with all their columns."""
    rows, members = _grouped(spark, docs, words, max_bits)
    kept = members.select("kept_id", "kept_hash").distinct()
    copies = (rows.groupBy("doc_id", "text_hash").count().filter("count > 1")
              .select(F.col("doc_id").alias("copy_id"), F.col("text_hash").alias("copy_hash")))
    own_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))

    def of(frame, keys, how):
        one, two = keys.columns
        return frame.join(keys, F.col("doc_id").cast("bigint").eqNullSafe(keys[one]) & (own_hash == keys[two]), how)

    def stage(frame):
        stay = of(frame, kept, "left_semi")
        return of(stay, copies, "left_anti").union(
            of(stay, copies, "left_semi").withColumn("_h", own_hash).dropDuplicates(["doc_id", "_h"]).drop("_h"))

    return base.shielded(docs, stage)


@base.register("op3_simhash_trie")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, base.table(spark, sf_dir, "documents"))

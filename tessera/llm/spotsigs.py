"""Operator 1: document fingerprints from SpotSigs.

Each common word (anchor) of a text, with the next two words that are not common, is a signature; a text's
fingerprint is the multiset of its signatures.  A second and later occurrence of a signature is an element of its
own, so that the Jaccard similarity of element sets is the one of multisets (sum of minima over sum of maxima).

``near_duplicates`` compares all fingerprints: equal ones form one class, classes are partitioned by set length,
only partitions whose lengths allow the threshold meet, and only over the rarest signatures of each class, one of
which any pair above the threshold shares.  ``neighbour_report`` compares each text with its edited version and with
the next text.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base

CHAIN_WORDS = 2
THRESHOLD = 0.8
#: Keys looked at to place the bounds of the partitions; every row is placed by them.
SAMPLE_KEYS = 20_000

# --- fixed values: common words of four languages, the anchors -------------------
ANCHORS = frozenset("""
a an and are as at be but by for from had has have he her his in is it its not of on or she that the their they this
to was were which with you
au aux avec ce ces dans de des du elle en est et eux il je la le les leur lui ma mais me même mes mon ne nos notre
nous ou par pas pour qu que qui sa se ses son sur ta te tes toi ton tu un une vos votre vous
al algo como con cual de del desde donde el ella ellas ellos en entre era es esa ese eso esta este la las lo los más
me mi muy no nos o para pero por que se sin sobre son su sus también te tu un una uno y ya
aber als am an auf aus bei bin bis das dass dem den der des die doch ein eine einem einen einer er es für hat ich ihr
im in ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war was wie wir zu zum zur
""".split())
# ---------------------------------------------------------------------------------

_WORDS = re.compile(r"[^\W_]+").findall
_STEP = 0x9E3779B97F4A7C15


def signatures(text: str, chain: int = CHAIN_WORDS, anchors: frozenset[str] = ANCHORS) -> list[int]:
    """The fingerprint: sorted 64-bit elements.  A text without any full chain has one signature, all its words (or,
    without words, all its characters); an empty text has none."""
    words = _WORDS(text.lower())
    found: list[str] = []
    rest = [""] * chain  # the next words that are no anchors, nearest first
    for w in reversed(words):
        if w in anchors:
            if rest[-1]:
                found.append(" ".join([w, *rest]))
        else:
            rest = [w, *rest[:-1]]
    if not found:
        found = [" ".join(words) or text] if text else []
    digest, seen, out = xxhash.xxh64_intdigest, {}, []
    for s in found:
        n = seen[s] = seen.get(s, -1) + 1
        out.append((digest(s) + n * _STEP) & 0xFFFFFFFFFFFFFFFF)
    out.sort()
    return out


def likeness(a: list[int], b: list[int], least: float = 0.0) -> float:
    """Jaccard similarity of two sorted fingerprints; 0 as soon as it can't reach ``least``.  Two empty ones are
    alike."""
    if not a and not b:
        return 1.0
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    need = math.ceil(least / (1 + least) * (len(a) + len(b)) - 1e-9)  # common elements that ``least`` takes
    if not need:
        common = len(set(a).intersection(b))
        return common / (len(a) + len(b) - common)
    i = j = common = 0
    while i < len(a) and j < len(b):
        if common + min(len(a) - i, len(b) - j) < need:
            return 0.0
        if a[i] == b[j]:
            common, i, j = common + 1, i + 1, j + 1
        elif a[i] < b[j]:
            i += 1
        else:
            j += 1
    return common / (len(a) + len(b) - common) if common >= need else 0.0


def printed(elements: list[int]) -> str:
    """The fingerprint as text: eight hex digits an element, in order."""
    return (np.array(elements, np.uint64) >> np.uint64(32)).astype(">u4").tobytes().hex()


# --- every text against its edited version and the next text ----------------------


def _order_key(doc_id, text_hash):
    """Sorts like descending id, null ids last, then descending hash."""
    return doc_id is None, -doc_id if doc_id is not None else 0, -text_hash


def _bounds(rows: DataFrame, n: int) -> list[tuple]:
    """n - 1 keys at most that cut the order into even parts, from a sample of about SAMPLE_KEYS."""
    total = rows.count()
    share = min(1.0, SAMPLE_KEYS / max(total, 1))
    keys = sorted(_order_key(*r) for r in rows.select("doc_id", "text_hash").filter(
        F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).collect())
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def _next_of(rows: DataFrame, n: int) -> DataFrame:
    """rows (doc_id, text_hash, text) dealt in descending order of id over n partitions: sorted by (bucket, ghost),
    where a ghost is the row that follows the bucket's last, cyclically."""
    bounds = _bounds(rows, n)

    @F.pandas_udf("int")
    def bucket(doc_id: pd.Series, text_hash: pd.Series) -> pd.Series:
        return pd.Series([bisect_left(bounds, _order_key(None if pd.isna(d) else int(d), int(h)))
                          for d, h in zip(doc_id, text_hash)], dtype="int32")

    own = rows.withColumn("bucket", bucket("doc_id", "text_hash"))
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("text_hash"))
    heads = sorted((r["bucket"], r["k"]["doc_id"], r["k"]["text_hash"]) for r in
                   own.select("bucket", key.alias("k")).groupBy("bucket").agg(F.max("k").alias("k")).collect())
    # the head of each bucket follows the last row of the bucket before it; the first follows the last of all
    before = {(d, h): heads[i - 1][0] for i, (_, d, h) in enumerate(heads)}

    @F.pandas_udf("array<int>")
    def places(doc_id: pd.Series, text_hash: pd.Series, bucket: pd.Series) -> pd.Series:
        asked = ((None if pd.isna(d) else int(d), int(h)) for d, h in zip(doc_id, text_hash))
        return pd.Series([[b, before[k]] if k in before else [b] for b, k in zip(bucket, asked)])

    dealt = own.select("doc_id", "text_hash", "text", F.posexplode(places("doc_id", "text_hash", "bucket")).alias("ghost", "to"))
    return dealt.repartitionById(n, F.col("to")).sortWithinPartitions(
        "to", "ghost", F.desc_nulls_last("doc_id"), F.desc("text_hash"))


def _compared(batches) -> Iterator[dict]:
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    last = None  # the row whose next comes
    for batch in batches:
        cols: dict[str, list] = {c: [] for c in names}
        size = 0
        for doc_id, text, bucket, ghost in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "to", "ghost"))):
            own = signatures(text)
            if last is not None and last[0] == bucket:
                _, last_id, before, mine = last
                half = len(before) // 2
                edited = before[:len(before) - half] + text[:half]
                changed = signatures(edited) if half else mine
                for c, v in zip(names, (last_id, len(before), hashlib.sha256(edited.encode()).hexdigest(), printed(mine),
                                        printed(changed), likeness(mine, changed), likeness(mine, own))):
                    cols[c].append(v)
                size += len(mine) + len(changed)
            last = None if ghost else (bucket, doc_id, text, own)
            if size > 1_000_000:
                yield cols
                cols, size = {c: [] for c in names}, 0
        yield cols


def neighbour_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    In descending order of id (null ids last, equal ids by a hash of their text) each text is compared with its
    edited version, whose last half comes from the start of the next text, and with the next text; after the last
    comes the first.  A null text counts as empty; repeated rows follow each other; a table of one row is its own
    next; an empty table gives no rows.
    """
    rows = base.texts(docs).withColumn("text_hash", F.xxhash64("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return base.arrow_map(_next_of(rows, n), _compared,
                          "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                          "edited_fingerprint string, near_edited double, near_next double")


# --- all texts against all -----------------------------------------------------------


def near_duplicates(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): members (doc_id, class_id) of every row, class_id being the smallest id among equal
    fingerprints; pairs (a, b, similarity) of the classes at or above ``threshold``, a <= b: classes are told apart by fingerprint,
    so those of one id (null ids, repeated ids) have their pairs too.

    Texts without signatures (empty, null) form one class; null ids count as -1; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            sets = [signatures(t) for t in batch.column("text").to_pylist()]
            yield {"doc_id": batch.column("doc_id"),
                   "elements": pa.array([np.array(s, np.uint64).view(np.int64) for s in sets], pa.list_(pa.int64()))}

    rows = base.arrow_map(base.texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1))), run,
                          "doc_id bigint, elements array<bigint>")
    rows = base.written(spark, rows.withColumn("digest", F.sha2(F.array_join(F.col("elements").cast("array<string>"), ","), 256)),
                        "spotsigs")
    classes = base.written(spark, rows.groupBy("digest").agg(F.min("doc_id").alias("class_id"), F.min("elements").alias("elements"))
                           .withColumn("length", F.size("elements")), "spotsigs-classes")
    members = rows.select("doc_id", "digest").join(classes.select("digest", "class_id"), "digest").select("doc_id", "class_id")
    # rarest elements first: a pair at the threshold shares one of the first length - threshold * length + 1
    each = classes.select("digest", "length", F.explode("elements").alias("element"))
    often = each.groupBy("element").agg(F.count("*").alias("often"))
    keep = F.col("length") - F.ceil(F.col("length") * threshold - 1e-9) + 1
    rare = (each.join(often.filter("often > 1"), "element").groupBy("digest", "length")
            .agg(F.array_sort(F.collect_list(F.struct("often", "element"))).alias("shared"))
            # elements that no other class has come first in the order and meet nothing
            .withColumn("room", (keep - (F.col("length") - F.size("shared"))).cast("int")).filter("room > 0")
            .select("digest", "length", F.explode(F.slice("shared", F.lit(1), F.col("room"))).alias("s"))
            .select("digest", "length", F.col("s.element").alias("element")))
    part = F.floor(F.log(F.col("length").cast("double")) / -math.log(threshold)).cast("int")
    left = rare.withColumn("part", part).withColumn("meets", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    right = rare.select(F.col("digest").alias("other"), F.col("length").alias("longer"), "element", part.alias("meets"))
    found = (left.join(right, ["element", "meets"])
             .filter((F.col("digest") != F.col("other")) & (F.col("longer") >= F.col("length"))
                     & ((F.col("longer") > F.col("length")) | (F.col("digest") < F.col("other")))
                     & (F.col("length") >= threshold * F.col("longer") - 1e-9))
             .select(F.col("digest").alias("da"), F.col("other").alias("db")).distinct())
    one = classes.select(F.col("digest").alias("da"), F.col("class_id").alias("ca"), F.col("elements").alias("ea"))
    two = classes.select(F.col("digest").alias("db"), F.col("class_id").alias("cb"), F.col("elements").alias("eb"))
    common = F.size(F.array_intersect("ea", "eb"))
    pairs = (found.join(one, "da").join(two, "db")
             .withColumn("similarity", common / (F.size("ea") + F.size("eb") - common))
             .filter(F.col("similarity") >= threshold - 1e-12).select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"), "similarity"))
    return members, pairs


@base.register("op1_spotsigs")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_report(spark, base.table(spark, sf_dir, "documents"))

"""Operator 9: nearest neighbours by inner product with an adaptive dimension scan.

Largest inner product becomes smallest distance: each vector gets one more component, so that all candidates have
the length of the longest, and a query gets a zero.  A random rotation then spreads every difference evenly over
the dimensions, so a distance over the first d of D rotated dimensions estimates the whole.  Vectors are dealt to
the lists of the nearest of ``n_lists`` centres; queries visit the lists of the ``n_probe`` nearest centres.

Within a probed list the columns are scanned in blocks.  After each block a hypothesis test per query and candidate
asks whether the distance so far, scaled to all dimensions, still allows the candidate to be among the query's k
nearest; if not, the candidate is abandoned.  What survives is scored exactly on the original vectors.

The centres come from a bounded sample; every vector is indexed and scanned.  A large list is dealt over several
tasks by vector, and each of them serves all of the list's queries in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base

NEIGHBOURS = 20
QUERY_EVERY = 20
#: Vectors that train the centres, at most, and rounds of training.
SAMPLE_VECTORS = 8192
TRAIN_ROUNDS = 8
LEAST_LISTS, MAX_LISTS = 32, 4096
#: Lists a query visits: this share of them, and never fewer than LEAST_PROBES.  A share this large is what vectors
#: without clusters need for a recall above 0.9; clustered ones need less.
PROBE_SHARE = 0.75
LEAST_PROBES = 16
#: And it goes on until the lists hold this many times the neighbours asked for.
LEAST_CANDIDATES = 10
#: Rotated dimensions per block, and the test's width: a candidate is abandoned when its scaled partial distance
#: exceeds the k-th best by a factor of (1 + EPSILON / sqrt(d)) ** 2.
BLOCK = 16
EPSILON = 1.0
#: Below this share of candidates left, they are gathered one by one instead of scanned in whole blocks.
SPARSE = 0.05
#: Vectors of one list in one task, and queries scanned at once.
LIST_VECTORS = 4096
QUERIES_AT_ONCE = 256
#: Equal query rows that get a neighbour at once.
COPIES_AT_ONCE = 1000


class Index:
    """Rotation and centres for one dimension; built from a sample, small enough to send to every task."""

    def __init__(self, sample: np.ndarray, longest: float, n_lists: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim, self.longest = sample.shape[1], longest
        q, r = np.linalg.qr(rng.standard_normal((self.dim + 1, self.dim + 1)))
        self.rotation = q * np.sign(np.diag(r))
        rows = self.candidates(sample)
        centres = rows[rng.permutation(len(rows))[:n_lists]]
        for _ in range(TRAIN_ROUNDS):
            own = self.nearest(rows, centres, 1)[:, 0]
            counts = np.bincount(own, minlength=len(centres))
            sums = np.zeros_like(centres)
            np.add.at(sums, own, rows)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        self.centres = centres

    def candidates(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated, with the component that evens the lengths."""
        rest = np.sqrt(np.maximum(self.longest ** 2 - (vectors ** 2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.rotation

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        """Rotated and brought to the candidates' length, which leaves their order by inner product as it is."""
        size = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
        return np.column_stack([vectors * (self.longest / size), np.zeros(len(vectors))]) @ self.rotation

    @staticmethod
    def nearest(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the n nearest centres per row, nearest first."""
        far = (centres ** 2).sum(axis=1) - 2 * rows @ centres.T
        if n == 1:
            return far.argmin(axis=1)[:, None]
        part = np.argpartition(far, n - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(far), 1))
        return np.take_along_axis(part, np.argsort(np.take_along_axis(far, part, 1), axis=1, kind="stable"), 1)


def scan_list(index: Index, ids, vectors, query_ids, query_vectors, k: int, query_keys=None):
    """Per query its k best of a list: (query's key, vec_id, score) arrays.  Ids ascend, so ties go to smaller ones.
    Without keys, a query's id is its key."""
    query_keys = query_ids if query_keys is None else query_keys
    rows, asked = index.candidates(vectors), index.queries(query_vectors)
    dims = rows.shape[1]
    out = []
    for at in range(0, len(asked), QUERIES_AT_ONCE):
        q, qid, original = asked[at:at + QUERIES_AT_ONCE], query_ids[at:at + QUERIES_AT_ONCE], query_vectors[at:at + QUERIES_AT_ONCE]
        key = query_keys[at:at + QUERIES_AT_ONCE]
        limit = np.full(len(q), np.inf)
        # the k-th best of an evenly drawn part of the list is a bound for the whole list
        probe = np.unique(np.linspace(0, len(rows) - 1, 16 * (k + 1)).astype(int))
        own = qid[:, None] == ids
        safe = np.zeros(own.shape, bool)  # the nearest k of that part are never abandoned: no list gives fewer
        if len(probe) > k:
            near = ((rows[probe] ** 2).sum(axis=1) - 2 * q @ rows[probe].T) + (q ** 2).sum(axis=1, keepdims=True)
            near[own[:, probe]] = np.inf
            best = np.argpartition(near, k - 1, axis=1)[:, :k]
            limit = np.take_along_axis(near, best, 1).max(axis=1)
            safe[np.arange(len(q))[:, None], probe[best]] = True
            safe &= ~own
        limit = np.maximum(limit, 0) + 1e-9
        part, d = np.zeros((len(q), len(rows))), 0
        alive = ~own
        who = what = None
        while d < dims:
            step = slice(d, min(d + BLOCK, dims))
            d = step.stop
            bound = limit * (1 + (EPSILON / np.sqrt(d) if d < dims else 1e-9)) ** 2 * d / dims
            if who is None:  # many candidates are left: whole column blocks at once
                part += (rows[:, step] ** 2).sum(axis=1) - 2 * q[:, step] @ rows[:, step].T
                part += (q[:, step] ** 2).sum(axis=1, keepdims=True)
                alive &= (part <= bound[:, None]) | safe
                if d == dims or alive.mean() < SPARSE:
                    who, what = np.nonzero(alive)
                    part = part[who, what]
            else:
                part = part + ((q[who, step] - rows[what, step]) ** 2).sum(axis=1)
                keep = (part <= bound[who]) | safe[who, what]
                who, what, part = who[keep], what[keep], part[keep]
        score = (original[who] * vectors[what]).sum(axis=1)
        order = np.lexsort((ids[what], -score, who))
        who, what, score = who[order], what[order], score[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        best = rank < k
        out.append((key[who[best]], ids[what[best]], score[best]))
    return [np.concatenate(x) for x in zip(*out)]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding array<float> or array<double>) of the vectors that take part."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
                       & F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
                       & F.exists("embedding", lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def search(spark: SparkSession, vectors: DataFrame, k: int = NEIGHBOURS, query_every: int = QUERY_EVERY,
           probe_share: float = PROBE_SHARE) -> DataFrame:
    """Per query (a row whose vec_id is divisible by ``query_every``): query_id, rank, vec_id, score of its k
    nearest by inner product, ties to the smaller vec_id.

    Null or zero vectors and those with null or non-finite components take no part; nor do vectors of another
    length than most have (of equally frequent lengths the larger), or without an id.  A query's own row, and any
    other with its id, is no candidate.  Repeated rows are searched as one each and may both be found: each row that
    asks has k ranks of its own, equal rows (same id and vector) the same ones.  An empty table gives no rows.
    """
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    good = usable(vectors)
    sizes = (good.groupBy(F.size("embedding").alias("dim"))
             .agg(F.count("*").alias("n"), F.max(F.expr("aggregate(embedding, 0D, (a, x) -> a + double(x) * x)")).alias("longest"))
             .orderBy(F.desc("n"), F.desc("dim")).limit(1).collect())
    if not sizes:
        return spark.createDataFrame([], schema)
    dim, n, longest = sizes[0]
    good = good.filter(F.size("embedding") == dim)
    part = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(1 << 20)) < int(min(1.0, SAMPLE_VECTORS / n) * (1 << 20))
    sample = [r[0] for r in good.filter(part).select("embedding").limit(2 * SAMPLE_VECTORS).collect()] or [
        r[0] for r in good.select("embedding").limit(1).collect()]
    n_lists = int(min(max(LEAST_LISTS, n / LIST_VECTORS), MAX_LISTS, len(sample)))
    index = spark.sparkContext.broadcast(Index(np.unique(np.array(sample), axis=0), np.sqrt(longest), n_lists))
    probes = max(LEAST_PROBES, int(probe_share * n_lists))

    def deal(batches):
        built = index.value
        for batch in batches:
            ids, rows = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            own = built.nearest(built.candidates(rows), built.centres, 1)[:, 0]
            yield {"list": own, "vec_id": ids, "embedding": batch.column("embedding")}

    kind = good.schema["embedding"].dataType.simpleString()
    listed = base.arrow_map(good, deal, f"list int, vec_id bigint, embedding {kind}")
    index_rows = base.written(spark, listed.withColumn("row", F.monotonically_increasing_id()), "vector-lists")
    # equal rows are searched once, and their neighbours given to each
    queries = base.written(spark, good.filter(F.pmod("vec_id", F.lit(query_every)) == 0).groupBy("vec_id", "embedding")
                           .agg(F.count("*").alias("copies")).withColumn("query_key", F.monotonically_increasing_id()),
                           "vector-queries")
    counts = {r["list"]: r["count"] for r in index_rows.groupBy("list").count().collect()}  # a row a list
    sizes = np.array([counts.get(i, 0) for i in range(len(index.value.centres))])
    splits = spark.sparkContext.broadcast({i: -(-c // LIST_VECTORS) for i, c in counts.items()})

    def ask(batches):
        built, parts = index.value, splits.value
        for batch in batches:
            ids, rows = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            near = built.nearest(built.queries(rows), built.centres, len(built.centres))
            before = sizes[near].cumsum(axis=1) - sizes[near]  # vectors in nearer lists
            visited = (np.arange(near.shape[1]) < probes) | (before < LEAST_CANDIDATES * k)
            who, rank = np.nonzero(visited)
            lists = near[who, rank]
            times = np.array([parts.get(int(i), 0) for i in lists], np.int64)
            who, lists = np.repeat(who, times), np.repeat(lists, times)
            nth = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times)
            yield {"list": lists, "part": nth, "vec_id": ids[who], "query_key": batch.column("query_key").take(pa.array(who)),
                   "embedding": batch.column("embedding").take(pa.array(who))}

    asked = base.arrow_map(queries.drop("copies"), ask,
                           f"list int, part int, vec_id bigint, query_key bigint, embedding {kind}")
    split_of = F.create_map(*[x for i, c in sorted(counts.items()) if c > LIST_VECTORS
                              for x in (F.lit(i), F.lit(-(-c // LIST_VECTORS)))]) if max(counts.values()) > LIST_VECTORS else None
    nth = F.lit(0) if split_of is None else F.pmod(F.xxhash64("row"), F.coalesce(split_of[F.col("list")], F.lit(1))).cast("int")
    held = index_rows.select("list", nth.alias("part"), "vec_id", F.lit(None).cast("bigint").alias("query_key"), "embedding")
    met = (held.union(asked).repartition("list", "part")
           .sortWithinPartitions("list", "part", F.col("query_key").isNotNull(), "vec_id"))

    def scan(batches):
        built = index.value
        ids, rows, now = np.zeros(0, np.int64), np.zeros((0, dim)), None
        kept: list[tuple] = []
        for batch in batches:
            lists, parts = batch.column("list").to_numpy(), batch.column("part").to_numpy()
            query = batch.column("query_key").is_valid().to_numpy(zero_copy_only=False)
            keys = batch.column("query_key").fill_null(-1).to_numpy()
            vec, matrix = batch.column("vec_id").to_numpy(), _matrix(batch.column("embedding"))
            cuts = np.flatnonzero(np.concatenate([[True], (lists[1:] != lists[:-1]) | (parts[1:] != parts[:-1])
                                                  | (query[1:] != query[:-1])]))
            for a, b in zip(cuts, np.append(cuts[1:], len(lists))):
                key = int(lists[a]), int(parts[a])
                if key != now:
                    now, kept = key, []
                if not query[a]:
                    kept.append((vec[a:b], matrix[a:b]))
                    ids = None
                    continue
                if not kept:
                    continue
                if ids is None:
                    ids, rows = np.concatenate([x[0] for x in kept]), np.concatenate([x[1] for x in kept])
                found = scan_list(built, ids, rows, vec[a:b], matrix[a:b], k, keys[a:b])
                yield {"query_key": found[0], "vec_id": found[1], "score": found[2]}

    hits = base.arrow_map(met, scan, "query_key bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    # a row for each of the equal query rows, those of many copies dealt over several tasks
    asking = queries.select("query_key", F.col("vec_id").alias("query_id"), "copies")
    blocks = (ranked.join(asking, "query_key")
              .withColumn("block", F.explode(F.expr(f"sequence(0, (copies - 1) div {COPIES_AT_ONCE})")))
              .repartition("query_key", "rank", "block"))
    return blocks.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.explode(F.expr(
        f"array_repeat(0, int(least({COPIES_AT_ONCE}, copies - block * {COPIES_AT_ONCE})))")).alias("copy")).drop("copy")


@base.register("op9_dimension_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark, base.table(spark, sf_dir, "embeddings"))

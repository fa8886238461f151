"""Near-duplicate and substring operators against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from samples import prose
import xxhash

from tessera.llm import simhash_trie, spotsigs, superkmer_dedup
from tessera.llm.components import connected_components


def key(r):
    return tuple((v is None, v) for v in r)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values, near):
    own = list(range(len(values)))

    def root(i):
        while own[i] != i:
            i = own[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                own[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_simhash_equals_brute_force(spark, docs, rows, none):
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    groups = brute_groups(prints, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, _, _), g in zip(rows, groups):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = [(i, f"{p:016x}", least.get(g)) for (i, _, _), p, g in zip(rows, prints, groups)]
    got = [tuple(r) for r in simhash_trie.near_duplicates(spark, docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert simhash_trie.near_duplicates(spark, none).count() == 0
    kept = simhash_trie.keep_one(spark, docs)
    assert kept.columns == docs.columns
    texts = Counter(groups[[(a, b) for a, b, _ in rows].index((r.doc_id, r.text))] for r in kept.collect())
    assert set(texts) == set(groups) and set(texts.values()) == {1}


@pytest.mark.parametrize("shard_rows", [50_000, 4])
def test_trie_links_connect_what_brute_force_connects(spark, shard_rows):
    rng = random.Random(1)
    values = {0, (1 << 64) - 1}
    for _ in range(30):
        seed = rng.getrandbits(64)
        for _ in range(12):
            seed ^= sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5)))
            values.add(seed)
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp bigint")
    links = [(int(np.int64(a).view(np.uint64)), int(np.int64(b).view(np.uint64)))
             for a, b in simhash_trie.fingerprint_links(frame, 3, shard_rows).collect()]
    assert all((a ^ b).bit_count() > 0 for a, b in links)
    place = {v: i for i, v in enumerate(values)}
    linked = {(place[a], place[b]) for a, b in links}
    want = brute_groups(values, lambda a, b: (a ^ b).bit_count() <= 3)
    got = brute_groups(range(len(values)), lambda a, b: (a, b) in linked or (b, a) in linked)
    pairs = lambda g: {(i, j) for i in range(len(g)) for j in range(i) if g[i] == g[j]}
    assert pairs(got) == pairs(want)


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r.node: r.root for r in connected_components(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 20 for i in range(21, 61)} | {i: 100 for i in range(101, 160)} | {201: 200, 202: 200}
    assert {k: v for k, v in got.items() if k != v} == want
    assert connected_components(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_kept(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return words, out


@pytest.mark.parametrize("window", [35, 8])
def test_substring_dedup_equals_brute_force(spark, docs, rows, none, window):
    words, kept = brute_kept([t for _, t, _ in rows], window)
    want = [(i, len(w), len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for (i, _, _), w, k in zip(rows, words, kept)]
    got = [tuple(r) for r in superkmer_dedup.report(spark, docs, window).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert superkmer_dedup.report(spark, none, window).count() == 0
    out = superkmer_dedup.remove_repeats(spark, docs, window)
    assert out.columns == docs.columns
    texts = sorted([(i, t if len(w) == len(k) else b" ".join(k).decode()) for (i, t, _), w, k in zip(rows, words, kept)], key=key)
    assert sorted([(r.doc_id, r.text) for r in out.collect()], key=key) == texts


def test_a_slice_is_hashed_in_stretches():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(40_000)}" for _ in range(880)) for _ in range(500)]
    texts[400] = texts[20]  # the same windows in two stretches of one slice
    batch = pa.record_batch({"id": np.arange(500), "key": np.arange(500) * 7, "text": texts})
    assert 2_000_000 < batch.column("text").nbytes < superkmer_dedup.SLICE_BYTES
    tracemalloc.start()
    out = list(superkmer_dedup._blocks(4, 35, 6, None)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 1 and sorted(b for b in out[0]["bucket"][:4]) == [0, 1, 2, 3]  # one block a bucket and slice
    spans = [(i, a, b) for i, a, b in zip(out[0]["id"], out[0]["a"], out[0]["b"]) if i is not None]
    assert spans == [(20, 0, 880), (400, 0, 880)]
    assert peak < 60_000_000


def test_frequent_sequences_are_found_all_the_same(spark):
    """A line that all texts share, and a passage that repeats within one text."""
    rng = random.Random(2)
    line = " ".join(f"l{i}" for i in range(12))
    texts = [f"{' '.join(f'w{rng.randrange(10**6)}' for _ in range(40))} {line} "
             f"{' '.join(f'v{rng.randrange(10**6)}' for _ in range(40))}" for _ in range(60)]
    texts[3] = texts[4].split(" ", 2)[2] + " tail " + texts[4]
    texts.append("z " * 90)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words, kept = brute_kept(texts, 35)
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in superkmer_dedup.report(spark, frame).collect()}
    assert got == {i: (len(w) - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, (w, k) in enumerate(zip(words, kept))}
    assert got[60][0] == 90 and got[0][0] == 0


def test_neighbours_equal_brute_force(spark, docs, rows, none):
    got = sorted([tuple(r) for r in spotsigs.neighbour_report(spark, docs).collect()], key=key)
    from pyspark.sql import functions as F

    order = [(r.doc_id, r.text or "") for r in docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).orderBy(
        F.desc_nulls_last("doc_id"), F.desc("h")).collect()]
    want = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (spotsigs.signatures(x) for x in (text, edited, after))
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.printed(a), spotsigs.printed(b),
                     spotsigs.likeness(a, b), spotsigs.likeness(a, c)))
    assert got == sorted(want, key=key)
    assert spotsigs.neighbour_report(spark, none).count() == 0
    one = spotsigs.neighbour_report(spark, spark.createDataFrame([(1, "the cat sat")], "doc_id bigint, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_pruned_likeness_is_jaccard_of_multisets():
    rng = random.Random(4)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(30), rng.randint(0, 20))) for _ in range(2))
        union = set(a) | set(b)
        exact = len(set(a) & set(b)) / len(union) if union else 1.0
        assert spotsigs.likeness(a, b) == exact
        for least in (0.3, 0.8):
            assert spotsigs.likeness(a, b, least) == (exact if exact >= least - 1e-12 else 0.0)
    twice = spotsigs.signatures("the cat sat the cat sat")
    assert len(set(twice)) == 2 and len(spotsigs.signatures("")) == 0 and len(spotsigs.signatures("!!")) == 1


def test_all_pairs_of_near_duplicates(spark, docs, rows, none):
    members, pairs = spotsigs.near_duplicates(spark, docs, 0.5)
    prints = {}
    for i, t, _ in rows:
        prints.setdefault(tuple(spotsigs.signatures(t or "")), []).append(-1 if i is None else i)
    want = {i: min(own) for own in prints.values() for i in own if i not in (-1, 140)}
    assert {r.doc_id: r.class_id for r in members.collect() if r.doc_id not in (-1, 140)} == want
    sets = sorted((min(own), list(p)) for p, own in prints.items() if p)
    found = {(a, b): spotsigs.likeness(x, y) for a, x in sets for b, y in sets if a < b}
    got = {(r.a, r.b): r.similarity for r in pairs.collect()}
    assert got == pytest.approx({k: v for k, v in found.items() if v >= 0.5 - 1e-12}) and len(got) >= 10
    members, pairs = spotsigs.near_duplicates(spark, none)
    assert members.count() == 0 and pairs.count() == 0


def test_near_duplicates_of_one_id(spark):
    """Near copies without ids, or all under one id, are linked, each pair once."""
    rng = random.Random(3)
    words = prose(rng, 200).split()
    texts = [" ".join([*words[:i], "Changed", *words[i + 1:]]) for i in (20, 90, 160)]
    sets = [spotsigs.signatures(t) for t in texts]
    want = sorted(spotsigs.likeness(a, b) for i, a in enumerate(sets) for b in sets[i + 1:] if a != b)
    assert len(want) == 3 and want[0] >= 0.5
    for doc_id in (None, 7):
        frame = spark.createDataFrame([(doc_id, t) for t in texts], "doc_id bigint, text string")
        pairs = spotsigs.near_duplicates(spark, frame, 0.5)[1].collect()
        assert sorted(r.similarity for r in pairs) == pytest.approx(want)
        assert {(r.a, r.b) for r in pairs} == {(doc_id or -1, doc_id or -1)}

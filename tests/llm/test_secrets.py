"""The secret scan against a plain Python twin: cut runs, battery, strata and thresholds; dense and long texts."""

import math
import random
import re
from collections import defaultdict

from tessera.llm import random_secrets as R
from test_models import base_spans, prose


def cut_runs(text, base):
    """Every run of RUN characters, cut at the base spans that touch it."""
    out = []
    for m in re.finditer(R.RUN, text):
        at, parts = m.start(), []
        for a, _, b in base:
            if a < m.end() and m.start() < b:
                parts.append((at, a, at > m.start(), True))
                at = max(at, b)
        parts.append((at, m.end(), at > m.start(), False))
        for a, b, cut_left, cut_right in parts:
            if b - a < R.RUN_LEAST:
                continue
            if cut_left and text[a] in "+/_-" and b - a > R.RUN_LEAST:
                a += 1
            if cut_right and text[b - 1] in "+/_-" and b - a > R.RUN_LEAST:
                b -= 1
            out.append((a, b))
    return out


def tail(z):
    z = min(max(z, -8.0), 8.0)
    return 1 / (1 + math.exp(1.5976 * z + 0.07056 * z ** 3))


def battery(run):
    """(stratum, p) of a run."""
    name, alphabet = next((n, a) for n, fits, a in R.ENCODINGS if re.search(fits, run))
    n, k = len(run), len(alphabet)
    x = [alphabet.find(c) + 1 for c in run]
    chi = sum(run.count(c) ** 2 for c in alphabet) * k / n - n
    p = [tail((chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))]
    groups = [(sum(c in cls for c in run), n * sum(c in cls for c in alphabet) / k) for cls in R.CLASSES]
    free = sum(due > 0 for _, due in groups) - 1
    group_chi = sum((seen - due) ** 2 / due for seen, due in groups if due > 0)
    c = 2 / (9 * max(free, 1))
    p.append(tail(0.0 if free < 1 else ((group_chi / free) ** (1 / 3) - 1 + c) / math.sqrt(c)))
    high = [v > (k + 1) / 2 for v in x]
    changes = 1 + sum(u != v for u, v in zip(high, high[1:]))
    m = 2 * sum(high) * (n - sum(high)) / n
    p.append(0.0 if m * (m - 1) <= 0 else 2 * tail(abs((changes - 1 - m) / math.sqrt(abs(m * (m - 1) / (n - 1))))))
    mean = sum(x) / n
    square = sum((v - mean) ** 2 for v in x)
    cross = sum((u - mean) * (v - mean) for u, v in zip(x, x[1:]))
    p.append(0.0 if square <= 0 else 2 * tail(abs(cross / square * math.sqrt(n))))
    return f"{name}:{sum(n > end for end in R.LENGTHS)}", 1 - (1 - min(min(p), 1.0)) ** 4


def twin(texts):
    """Per text its spans as the query prints them, and its redacted form."""
    base = [base_spans(t) for t in texts]
    runs = [[(a, b, *battery(t[a:b])) for a, b in cut_runs(t, s)] for t, s in zip(texts, base)]
    bins = defaultdict(lambda: [0] * R.BINS)
    for each in runs:
        for _, _, stratum, p in each:
            bins[stratum][min(int(p * R.BINS), R.BINS - 1)] += 1
    least = {}
    for stratum, n in bins.items():
        due = 2 * sum(n[R.BINS // 2:])
        fits = [b for b in range(R.BINS) if sum(n[b:]) and 1 - due * (1 - b / R.BINS) / sum(n[b:]) <= R.FALSE_SHARE]
        if fits:
            least[stratum] = max(fits[0] / R.BINS, 1e-3)
    out = []
    for t, spans, each in zip(texts, base, runs):
        spans = sorted(spans + [(a, 3, b) for a, b, stratum, p in each if p >= least.get(stratum, 2.0)])
        shown, at = "", 0
        for a, _, b in spans:
            if a >= at:
                shown += t[at:a] + R.REDACTED
            at = max(at, b)
        out.append((",".join(f"{R.KINDS[k]}:{a}:{b}" for a, k, b in spans), shown + t[at:]))
    return out


LETTERS = R.UPPER + R.LOWER + R.DIGITS


def dense(rng, n):
    """n findings of all kinds, next to each other, overlapping and apart, between characters of one to four bytes."""
    def some(alphabet, k):
        return "".join(rng.choices(alphabet, k=k))

    shapes = [lambda: f"api_key={some(LETTERS, 12)}", lambda: some(LETTERS, 40), lambda: "AKIA" + some(R.UPPER, 16) + "TOKEN=" + some(LETTERS, 9),
              lambda: some("0123456789abcdef", 30) + "pi_key: " + some(LETTERS, 7), lambda: "AKIA" + some(R.UPPER, 20) + "/" + some(LETTERS, 33),
              lambda: some(LETTERS, 25) + "-" + some("0123456789abcdef", 32) + "_" + some(LETTERS, 21), lambda: "secret=abc",
              lambda: "\0-" + some(LETTERS, 26), lambda: "the words of a sentence", lambda: "token=token: " + some(LETTERS, 8)]
    return "".join(rng.choice(shapes)() + rng.choice([" ", "\n", "é ", "😀", "\0", "/", ""]) for _ in range(n))


def test_twin_of_battery_strata_and_thresholds(spark):
    rng = random.Random(31)
    texts = [f"{prose(rng, 8)} {dense(rng, rng.randrange(6))} {prose(rng, 4)}" for _ in range(150)]
    texts += ["", "a" * 70, "A" * 30 + "-" + "0" * 40, f"{'é' * 5000} {dense(rng, 3)} {'😀' * 4096}{dense(rng, 2)}"]
    # more findings than a block of the walk holds, in more text than a block of it; blocks end inside of spans
    texts += [dense(rng, 1500), "x" * (R.BLOCK - 4) + " token=" + "y" * (2 * R.BLOCK) + " " + dense(rng, R.WALK)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    want = twin(texts)
    assert any("random" in spans for spans, _ in want)
    for r in R.scan(spark, frame).collect():
        assert r.spans == want[r.doc_id][0], r.doc_id
    for r in R.redact(spark, frame).collect():
        assert r.text == want[r.doc_id][1], r.doc_id


def test_running_joins_over_many_blocks(spark):
    from pyspark.sql import functions as F
    rng = random.Random(5)
    sizes = [0, 1, R.WALK - 1, R.WALK, R.WALK + 1, 5 * R.WALK + 3]
    rows = [(n, [rng.randrange(1000) for _ in range(n)]) for n in sizes]
    frame = spark.createDataFrame(rows, "n int, v array<int>")
    for r in frame.select("v", R._before(F.col("v"), lambda a, b: a + b).alias("sums"),
                          R._before(F.col("v"), F.greatest).alias("tops")).collect():
        assert r.sums == [sum(r.v[:i]) for i in range(len(r.v))]
        assert r.tops == [max([0, *r.v[:i]]) for i in range(len(r.v))]

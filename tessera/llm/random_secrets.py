"""Operator 10: secret scan with a randomness test battery, in DataFrame functions only.

Three base kinds are found by pattern.  Besides, every run of 20 or more letters, digits and ``+/_-`` outside them
(a run that touches base spans is cut at them, and each stretch of 20 or more that remains is a run of its own) is tested for being random characters of the encoding its characters suggest:

* chi-squared uniformity over the encoding's alphabet, and over classes of characters (digits, vowels, frequent
  consonants, the rest) that tell written language from random characters even in short runs;
* a runs test of the upper against the lower half of the alphabet;
* serial correlation between neighbours.

The least of the four p-values, corrected for taking the least of four (Sidak), is the run's p-value.  Random runs
have evenly spread p-values, others mostly tiny ones.  Runs are dealt into strata of encoding and length, since a short run gives the tests
little power.  In each stratum, twice the number of runs above 0.5 estimates how many are random; the threshold is
the lowest at which the runs above it that this doesn't account for, the false discoveries, are at most
``FALSE_SHARE`` of them.  The counts behind it cover all documents: a table of strata and p-value bins.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base

# --- fixed values -------------------------------------------------------------
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = (r"""(?=[pPsStTaA])(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of under 20 holds no longer one
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6
RUN = r"[A-Za-z0-9+/_-]{20,}"
RUN_LEAST = 20
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Name, what all characters must be, alphabet in order of its values; the first that fits is inferred.
ENCODINGS = [
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("HEX", "^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("base32", "^[A-Z2-7]+$", UPPER + DIGITS[2:8]),
    ("lower", "^[a-z0-9]+$", DIGITS + LOWER),
    ("upper", "^[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", "^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    ("base64", "", UPPER + LOWER + DIGITS + "+/-_"),
]
CLASSES = [DIGITS, "aeiouAEIOU", "nrtlsdhNRTLSDH", "bcfgjkmpqvwxyzBCFGJKMPQVWXYZ"]
# ------------------------------------------------------------------------------
#: Upper ends of the length strata, in characters; the last has no end.
LENGTHS = [24, 32, 48, 64, 128]
BINS = 50
FALSE_SHARE = 0.1
#: Values walked one by one before the next block; characters of a block of text.
WALK, BLOCK = 256, 4096
MASK = "\0"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once, however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(values: Column, join, zero: int = 0) -> Column:
    """For each of an array of integers ``join`` (associative) of all before it, ``zero`` for the first.  Blocks are
    walked by themselves and then moved by what lies before them, so an array grows by appending for a block at most:
    the time is about linear in the length."""
    empty = F.array().cast("array<int>")
    start = F.struct(F.lit(zero).alias("at"), empty.alias("out"))

    def walked(array, value):
        return F.aggregate(array, start, lambda acc, v: F.struct(
            join(acc["at"], value(v)).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")))

    def moved(inner):
        starts = walked(inner, lambda b: b["at"])["out"]
        return F.flatten(F.zip_with(inner, starts, lambda b, s: F.transform(b["out"], lambda x: join(s, x))))

    def blocks(v):
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / WALK).cast("int")),
                           lambda i: walked(F.slice(v, i * WALK + 1, F.lit(WALK)), lambda x: x))

    return _let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(_let(blocks(v), moved)))


def _matches(text: Column, pattern: str, group: int | None = None, least: int = 0, mark: str | None = None) -> Column:
    """array<struct<start, end, text>> of the pattern's matches (code points, end exclusive), leftmost first and
    not overlapping; ``group`` must have ``least`` characters.  Empty if there are none.  With ``mark`` also
    left and right: 1 if that character comes right before or after the match."""
    p = F.lit(pattern)
    found = F.regexp_extract_all(text, p, F.lit(0))
    part = F.regexp_extract_all(text, p, F.lit(group)) if group else found
    none = F.array().cast(f"array<struct<start:int,end:int,text:string{',left:int,right:int' if mark else ''}>>")

    def placed(both):
        before = _before(F.transform(both, lambda x: x["gap"] + F.length(x["m"])), lambda u, v: u + v)
        spans = F.zip_with(both, before, lambda x, at: F.struct(
            (at + x["gap"]).alias("start"), (at + x["gap"] + F.length(x["m"])).alias("end"), x["m"].alias("text"),
            *[x[c].alias(c) for c in (("left", "right") if mark else ("n",))]))
        if mark:
            return spans
        if least:
            spans = F.filter(spans, lambda s: s["n"] >= least)
        return F.transform(spans, lambda s: F.struct(*[s[c].alias(c) for c in ("start", "end", "text")]))

    def lengths(x, g):
        sides = [F.length(g).alias("n")] if not mark else [
            x["b"].endswith(mark).cast("int").alias("left"), x["a"].startswith(mark).cast("int").alias("right")]
        return F.struct(F.length(x["b"]).alias("gap"), x["m"].alias("m"), *sides)

    def split(between):
        parts = [F.slice(between, F.lit(1), F.size(between) - 1).alias("b"), found.alias("m")]
        if mark:
            parts.append(F.slice(between, F.lit(2), F.size(between) - 1).alias("a"))
        return F.zip_with(F.arrays_zip(*parts), part, lengths)

    return F.when(text.rlike(pattern), _let(_let(F.split(text, pattern, -1), split), placed)).otherwise(none)


def _pieces(text: Column, cuts: Column, made) -> Column:
    """The strings ``made(cut, between)`` of an array of cuts, joined; ``between(a, b)`` is the text from code point a
    to b.  The text is cut into blocks first, so that a piece is not looked for from the start of the text."""
    def joined(blocks):
        def between(a, b):
            first = F.floor(a / BLOCK).cast("int")
            some = F.slice(blocks, first + 1, F.floor(b / BLOCK).cast("int") - first + 1)
            return F.when(b > a, F.array_join(some, "").substr(a - first * BLOCK + 1, b - a)).otherwise(F.lit(""))

        return F.array_join(F.transform(cuts, lambda c: made(c, between)), "")

    return _let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), joined)


def _cuts(spans: Column, text: Column) -> Column:
    """Sorted spans as array<struct<at, start, end, last>>: ``at`` is the furthest end before a span.  The last one is
    empty and stands at the end of the text."""
    def cut(start, end, last):
        return F.struct(start.alias("start"), end.alias("end"), F.lit(last).alias("last"))

    all_ = F.concat(F.transform(spans, lambda s: cut(s["start"], s["end"], False)),
                    F.array(cut(F.length(text), F.length(text), True)))
    return _let(all_, lambda a: F.zip_with(a, _before(F.transform(a, lambda s: s["end"]), F.greatest), lambda s, p: F.struct(
        p.alias("at"), s["start"].alias("start"), s["end"].alias("end"), s["last"].alias("last"))))


def _kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a logistic approximation good to 0.0002."""
    z = F.least(F.greatest(z, F.lit(-8.0)), F.lit(8.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _in_order(table: list[tuple[str, str, object]], run: Column, pick) -> Column:
    out = None
    for name, fits, alphabet in reversed(table):
        value = pick(name, alphabet)
        out = value if out is None else F.when(run.rlike(fits), value).otherwise(out)
    return out


def _tested(runs: Column) -> Column:
    """runs: array<struct<start, end, text>> -> the same with stratum and p of each."""
    a = F.transform(runs, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["text"].alias("text"),
        F.length(r["text"]).cast("double").alias("n"),
        _in_order(ENCODINGS, r["text"], lambda name, _: F.lit(name)).alias("encoding"),
        _in_order(ENCODINGS, r["text"], lambda _, alphabet: F.lit(alphabet)).alias("alphabet")))
    b = F.transform(a, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["n"].alias("n"),
        F.length(r["alphabet"]).cast("double").alias("k"),
        F.transform(F.split(r["text"], ""), lambda c: F.instr(r["alphabet"], c).cast("double")).alias("x"),
        F.transform(F.split(r["alphabet"], ""), lambda c: (F.length(r["text"]) - F.length(
            F.replace(r["text"], c, F.lit("")))).cast("double")).alias("counts"),
        F.array(*[F.struct((F.length(r["text"]) - F.length(F.translate(r["text"], cls, ""))).cast("double").alias("seen"),
                           (r["n"] * (F.length(r["alphabet"]) - F.length(F.translate(r["alphabet"], cls, "")))
                            / F.length(r["alphabet"])).alias("due")) for cls in CLASSES]).alias("classes")))

    def total(array: Column, term) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + term(v))

    c = F.transform(b, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["n"].alias("n"),
        r["k"].alias("k"),
        (total(r["counts"], lambda v: v * v) * r["k"] / r["n"] - r["n"]).alias("chi"),
        total(r["classes"], lambda v: F.when(v["due"] > 0, (v["seen"] - v["due"]) * (v["seen"] - v["due"]) / v["due"])
              .otherwise(0.0)).alias("class_chi"),
        total(r["classes"], lambda v: (v["due"] > 0).cast("double")).alias("n_classes"),
        (total(r["x"], lambda v: v) / r["n"]).alias("mean"), r["x"].alias("x"),
        total(r["x"], lambda v: (v > (r["k"] + 1) / 2).cast("double")).alias("high"),
        F.zip_with(F.slice(r["x"], F.lit(1), F.size(r["x"]) - 1), F.slice(r["x"], F.lit(2), F.size(r["x"]) - 1),
                   lambda u, v: F.struct(u.alias("u"), v.alias("v"))).alias("next")))
    d = F.transform(c, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["n"].alias("n"),
        ((r["chi"] - (r["k"] - 1)) / F.sqrt(2 * (r["k"] - 1) * (r["n"] - 1) / r["n"])).alias("z_chi"),
        _wilson_hilferty(r["class_chi"], r["n_classes"] - 1).alias("z_class"),
        (1 + total(r["next"], lambda v: ((v["u"] > (r["k"] + 1) / 2) != (v["v"] > (r["k"] + 1) / 2)).cast("double")))
        .alias("runs"), (2 * r["high"] * (r["n"] - r["high"]) / r["n"]).alias("m"),
        total(r["next"], lambda v: (v["u"] - r["mean"]) * (v["v"] - r["mean"])).alias("cross"),
        total(r["x"], lambda v: (v - r["mean"]) * (v - r["mean"])).alias("square")))
    e = F.transform(d, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), r["encoding"].alias("encoding"), r["n"].alias("n"),
        F.array(_tail(r["z_chi"]), _tail(r["z_class"]),
                # one value or half only: as far from random as can be
                F.when(r["m"] * (r["m"] - 1) <= 0, F.lit(0.0)).otherwise(2 * _tail(F.abs(
                    (r["runs"] - 1 - r["m"]) / F.sqrt(F.abs(r["m"] * (r["m"] - 1) / (r["n"] - 1)))))),
                F.when(r["square"] <= 0, F.lit(0.0)).otherwise(2 * _tail(F.abs(
                    r["cross"] / r["square"] * F.sqrt(r["n"]))))).alias("p")))
    return F.transform(e, lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"),
        F.concat_ws(":", r["encoding"], sum(((r["n"] > n).cast("int") for n in LENGTHS), F.lit(0)).cast("string"))
        .alias("stratum"), (1 - F.pow(1 - F.least(F.array_min(r["p"]), F.lit(1.0)), F.lit(4.0))).alias("p")))


def _wilson_hilferty(chi: Column, df: Column) -> Column:
    """Normal score of a chi-squared value; no freedom: 0."""
    c = 2 / (9 * F.greatest(df, F.lit(1.0)))
    return F.when(df < 1, F.lit(0.0)).otherwise((F.pow(chi / df, F.lit(1 / 3)) - 1 + c) / F.sqrt(c))


def _outside(text: Column, spans: Column) -> Column:
    """The runs of the text without what the sorted spans cover: each remaining stretch of RUN_LEAST or more.  One
    separator next to a span is left out too if as many remain, so that the stretch's encoding is not the
    separator's.  A text with spans is searched with the spans' characters masked."""
    def masked(cut, between):
        covered = cut["end"] - F.greatest(cut["start"], cut["at"])
        return F.concat(between(cut["at"], cut["start"]), F.repeat(F.lit(MASK), F.greatest(covered, F.lit(0))))

    def trimmed(run):
        n = F.length(run["text"])
        left = F.when((run["left"] == 1) & run["text"].rlike("^[+/_-]") & (n > RUN_LEAST), 1).otherwise(0)
        right = F.when((run["right"] == 1) & run["text"].rlike("[+/_-]$") & (n - left > RUN_LEAST), 1).otherwise(0)
        return F.struct((run["start"] + left).alias("start"), (run["end"] - right).alias("end"),
                        run["text"].substr(left + 1, n - left - right).alias("text"))

    free = F.translate(text, MASK, " ")  # a text's own characters mask nothing
    cut = _let(_pieces(free, _cuts(spans, text), masked), lambda m: _matches(m, RUN, mark=MASK))
    return F.when(F.size(spans) == 0, _matches(text, RUN)).otherwise(F.transform(cut, trimmed))


def with_findings(docs: DataFrame) -> DataFrame:
    """docs with ``_base`` (array<struct<start, kind, end>>, sorted) and ``_runs`` (tested runs outside them)."""
    text = F.col("_text")
    return (docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
            .withColumn("_base", F.array_sort(F.concat(_kind(_matches(text, ASSIGN, 2, ASSIGN_VALUE), 0),
                                                       _kind(_matches(text, ACCESS), 1), _kind(_matches(text, HEX), 2))))
            .withColumn("_runs", _outside(text, F.col("_base")))
            .withColumn("_runs", F.when(F.size("_runs") > 0, _tested(F.col("_runs")))
                        .otherwise(F.array().cast("array<struct<start:int,end:int,stratum:string,p:double>>")))
            .drop("_text"))


def thresholds(found: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, float]:
    """Least p-value per stratum that counts as random; a stratum without one is left out.  Reads a table of at
    most strata times bins rows."""
    bins = (found.select(F.explode("_runs").alias("r"))
            .groupBy(F.col("r.stratum").alias("stratum"), F.least(F.floor(F.col("r.p") * BINS), F.lit(BINS - 1)).alias("bin"))
            .count())
    counts: dict[str, list[int]] = defaultdict(lambda: [0] * BINS)
    for row in bins.collect():
        counts[row["stratum"]][int(row["bin"])] = row["count"]
    out = {}
    for stratum, n in counts.items():
        random = 2 * sum(n[BINS // 2:])
        for b in range(BINS):
            above = sum(n[b:])
            if above and 1 - random * (1 - b / BINS) / above <= false_share:
                out[stratum] = max(b / BINS, 1e-3)
                break
    return out


def _spans(least: dict[str, float]) -> Column:
    """All spans, base ones and runs found random, sorted."""
    if not least:
        return F.col("_base")
    table = F.create_map(*[x for k, v in sorted(least.items()) for x in (F.lit(k), F.lit(v))])
    random = F.filter("_runs", lambda r: r["p"] >= F.coalesce(table[r["stratum"]], F.lit(2.0)))
    return F.array_sort(F.concat("_base", _kind(random, 3)))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def scan(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans.

    Spans are kind:start:end in code points, end exclusive, by start, then kind.  A null text counts as empty and
    has none; repeated rows are rows of their own and count each in the false-discovery control; an empty table
    gives no rows.
    """
    found = base.written(spark, with_findings(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
                         .select("doc_id", "_base", "_runs"), "findings")
    spans = _spans(thresholds(found))

    def n(kind):
        return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.withColumn("_spans", spans).select(
        "doc_id", *[n(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


REDACTED = "[SECRET]"


def redact(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with every stretch of found spans in ``text`` replaced by a marker, and ``n_chars``, if there, counted
    anew.  Rows without a finding stay as they are, null texts too; no row goes.  The rows are written once with what
    the battery found in them; thresholds and texts are both made from that table."""
    text = F.col("text").cast("string")

    def marked(cut, between):
        return F.when(cut["start"] >= cut["at"], F.concat(between(cut["at"], cut["start"]), F.when(
            cut["last"], F.lit("")).otherwise(F.lit(REDACTED)))).otherwise(F.lit(""))

    changed = {"text": F.when(F.size("_spans") > 0, _pieces(text, _cuts(F.col("_spans"), text), marked))
               .otherwise(F.col("text"))}

    def stage(frame):
        found = base.written(spark, with_findings(frame), "findings")
        out = found.withColumn("_spans", _spans(thresholds(found))).withColumns(changed)
        if "n_chars" in frame.columns:
            out = out.withColumn("n_chars", F.when(F.size("_spans") > 0, F.length("text").cast(
                frame.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
        return out

    return base.shielded(docs, stage)


@base.register("op10_random_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark, base.table(spark, sf_dir, "documents"))

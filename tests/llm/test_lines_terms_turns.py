"""Line dedup, term scan and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from samples import prose

from tessera.llm import base, line_dedup, term_scan, turn_repair

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
UPPER = {c: chr(c + 32) for c in range(65, 91)}


def key(r):
    return tuple((v is None, v) for v in r)


# --- op13 -----------------------------------------------------------------------
def brute_lines(rows, min_docs, keep_first=False):
    def keyed(line):
        return line.strip(SPACE).translate(UPPER)

    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if keyed(line):
                holders[keyed(line)].add((i, t or ""))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[keyed(x)]) < min_docs] if not keep_first else None
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def line_rows():
    rng = random.Random(3)
    common = [prose(rng, 8) for _ in range(30)]
    rows = []
    for i in range(60):
        lines = [rng.choice(["", "  ", prose(rng, 5)] + common) for _ in range(rng.randint(1, 30))]
        rows.append((i, "\n".join(rng.choice([x, f" {x.upper()}\t", x]) for x in lines)))
    rows += [(100 + i, "shared\nshared\nlast") for i in range(40)] + [(200, None), (201, ""), (202, "\n\n"), (None, "shared"),
             (None, None), (None, "shared\nown"), (203, "same\nrow"), (203, "same\nrow"), (203, "same\nrow"),
             (0, "shared\nzero"), (204, "shared\r\n SHARED \n" * 500), (205, "É\né\nshared")]
    return rows


@pytest.mark.parametrize("min_docs", [1, 3, 10])
@pytest.mark.parametrize("parts", [1, 40])
def test_lines(spark, min_docs, parts):
    rows = line_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)  # more parts: runs of equal hashes go over several
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = spark.createDataFrame([(i, t, 1, 2, "k", "b") for i, t in rows],
                                     "doc_id bigint, text string, h1 int, pos int, key string, body string")
        got = [tuple(r) for r in line_dedup.drop_lines(spark, docs, min_docs).select(
            "doc_id", "text", "n_lines", "n_dropped").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(got, key=key) == sorted(brute_lines(rows, min_docs), key=key)


def test_lines_keep_first(spark):
    rows = [(i, f"all\nown {i}\nall" + ("\npair" if i < 2 else "")) for i in range(50)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.text for r in line_dedup.drop_lines(spark, docs, 2, keep_first=True).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {0: "all\nown 0\npair", **{i: f"own {i}" for i in range(1, 50)}}


def test_lines_of_no_documents_and_bitmaps(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.drop_lines(spark, none).count() == 0
    docs = base.texts(spark.createDataFrame([(i, "a\nb\na" + "\nc" * i) for i in range(3)], "doc_id bigint, text string"))
    bitmaps = line_dedup.keep_bitmaps(spark, docs, 3).collect()
    assert all(list(line_dedup.keep_bits(r.bitmap, 20)[:3]) == [False] * 3 and line_dedup.keep_bits(r.bitmap, 20)[3:].all()
               for r in bitmaps) and len(bitmaps) == 3 and all(zlib.decompress(r.bitmap) for r in bitmaps)


# --- op12 -----------------------------------------------------------------------
def brute_search(docs, items, top):
    import math
    split = re.compile(term_scan.TERM)
    held = [(i, Counter(split.findall((t or "").translate(UPPER)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in sorted(set(items), key=key):
        scores = []
        for d, c in held:
            m = 75 + (25 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                (1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split.findall((text or "").translate(UPPER)) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda s: s[:3])[:top])]
    return out


@pytest.mark.parametrize("block_bytes, top, piece", [(4 << 20, 20, 1 << 20), (300, 3, 50)])
def test_terms(spark, rows, block_bytes, top, piece, monkeypatch):
    rng = random.Random(8)
    docs = [(i, t) for i, t, _ in rows] + [(i, "tie the tie") for i in range(500, 530)] + [
        (531, " nbsp   x İstanbul\x00the-THE_the.Ärger ärger"), (532, "薰\x85 q")]
    items = [(i, prose(rng, 6, rng.choice(["en", "de", "fr"]))) for i in range(20)] + [
        (50, None), (51, ""), (None, "the the the"), (52, "tie tie the"), (52, "und"), (53, "Ärger İstanbul  nbsp  nowhere"),
        (54, "same"), (54, "same"), (55, prose(rng, 300)), (56, "?!")]
    monkeypatch.setattr(term_scan, "PIECE", piece)
    frame = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id bigint, text string, item int, score int").repartition(5)
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    got = [tuple(r) for r in term_scan.search(spark, frame, asked, top, block_bytes).collect()]
    assert sorted(got, key=key) == sorted(brute_search(docs, items, top), key=key)


def test_terms_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert term_scan.search(spark, none, items).count() == 0
    assert term_scan.search(spark, items.withColumnRenamed("item_id", "doc_id"), items.limit(0)).count() == 0


def test_pieces_cut_between_terms(monkeypatch):
    monkeypatch.setattr(term_scan, "PIECE", 7)
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "bb", "long" * 5, "", "bb"]) for _ in range(200))
    n, known = term_scan.Automaton(["a", "bb", "zz"]).count(text.encode())
    words = text.split()
    assert n == len(words) and known == Counter({0: words.count("a"), 1: words.count("bb")})


# --- op11 -----------------------------------------------------------------------
def brute_faults(rows):
    """blank, duplicate, truncated of each row."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def brute_repair(rows):
    """The least (cost, audit) by trying strings of edits in order of cost: whole strings as states."""
    faults = brute_faults(rows)
    pattern = re.compile(r"(s?(ua)*u?)?")
    ways = {"": (0, "", ())}  # initials so far, shortened to what matters -> best

    def place(initials):
        return initials if initials in ("", "s") else initials[-1]

    def offer(best, initials, value):
        at = place(initials)
        if at not in best or value[:2] < best[at][:2]:
            best[at] = value

    def inserted(ways):
        for _ in range(3):
            more = dict(ways)
            for at, (cost, audit, turns) in ways.items():
                nxt = "a" if at == "u" else "u"
                offer(more, at + nxt, (cost + 5, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[nxt], ""))))
            ways = more
        return ways

    for (_, role, text), fault in zip(rows, faults):
        best = {}
        for at, (cost, audit, turns) in inserted(ways).items():
            offer(best, at, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            for letter, more, new in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                initials = at + new[:1]
                if new[:1] in ("s", "u", "a") and pattern.fullmatch({"": "", "s": "s", "u": "u", "a": "ua"}[at] + new[:1]):
                    offer(best, initials, (cost + more + extra, audit + letter, (*turns, (new, text))))
        ways = best
    ends = [v for at, v in inserted(ways).items() if at in ("", "a")]
    return min(ends, key=lambda v: v[:2])


def brute_report(rows):
    turns = {t for t, _, _ in rows if t is not None}
    faults = Counter(brute_faults(rows))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit, kept = brute_repair(rows)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def random_rows(rng, n):
    return [(rng.choice([None, rng.randint(0, 9)]), rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "u"]),
             rng.choice(["Fine.", "So?", "cut off", "", " \t", f"No {rng.randint(0, 99)}!", "cut off ", "end.\n"]))
            for _ in range(n)]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


@pytest.mark.parametrize("nodes", [4096, 8])
def test_repair_equals_whole_strings(nodes):
    rng = random.Random(nodes)
    for _ in range(1500):
        rows = in_order(random_rows(rng, rng.choice([0, 1, 2, 3, 5, 8, 14, 40])))
        c = turn_repair.Conversation(turn_repair._Digest(), nodes=nodes)
        for r in rows:
            c.add(*r)
        report = c.end()
        assert (*report.values(), c.out.sha.hexdigest()) == brute_report(rows), rows


def test_every_audit_of_short_conversations():
    """The dynamic programs against all strings of edits."""
    cost = {"K": 0, "R": 1, "D": 2, "I": 5}
    rng = random.Random(1)
    for _ in range(40):
        rows = in_order(random_rows(rng, rng.randint(0, 3)))
        faults, best = brute_faults(rows), None
        for n in range(7):
            for audit in itertools.product("DIKR", repeat=n):
                if len([e for e in audit if e != "I"]) != len(rows):
                    continue
                options, total, i = [""], 0, 0
                for e in audit:
                    total += cost[e]
                    if e != "I":
                        total += 5 * (faults[i] == "truncated" and e != "D")
                        if e != "D" and faults[i] in ("blank", "duplicate"):
                            options = []
                        own = [rows[i][1][:1] or "-"]
                        i += 1
                    options = [o + x for o in options for x in ([""] if e == "D" else own if e == "K" else "ua")]
                if any(re.fullmatch("(s?(ua)+)?", o) for o in options) and (best is None or (total, "".join(audit)) < best):
                    best = (total, "".join(audit))
        assert brute_repair(rows)[:2] == best


def test_edits_compare_as_strings(monkeypatch):
    for prime in (turn_repair.PRIME, 3):  # 3: nearly all hashes are equal, so each is verified
        monkeypatch.setattr(turn_repair, "PRIME", prime)
        rng = random.Random(4)
        edits = turn_repair.Edits()
        for _ in range(300):
            edits.add(rng.randrange(max(0, len(edits.up) - 6), len(edits.up)), rng.choice("DK"))
        for _ in range(3000):
            a, b = rng.randrange(300), rng.randrange(300)
            x, y = rng.choice("DIKR"), rng.choice("DIKR")
            assert edits.less(a, x, b, y) == (edits.path(a) + x < edits.path(b) + y)


def test_settled_rows_are_given_up():
    out = []
    c = turn_repair.Conversation(lambda *turn: out.append(turn))
    for i in range(60_000):
        c.add(i, "user" if i % 2 == 0 else "assistant", f"Text {i}." if i % 7 else f"open {i}")
        assert len(c.edits.up) < 3 * turn_repair.NODES and len(c.rows) < 2 * turn_repair.NODES
    assert len(c.end()["audit"]) >= 60_000 and len(out) > 40_000


def damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv]
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: in_order(r) for c, r in out.items()}


def test_repair_of_tables(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rng = random.Random(9)
    for conv in range(1000, 1300):
        given += [(conv, t, r, x) for t, r, x in random_rows(rng, rng.randint(1, 6))]
    given += [(None, None, None, None), (None, 1, "user", None), (None, 2, None, "x"), (2000, -5, "assistant", "a " * 300_000)]
    frame = spark.createDataFrame([(*r, 7, 8) for r in given], "conv_id bigint, turn bigint, role string, text string, "
                                  "cost int, _kind int").repartition(6)
    want = [(c, *brute_report(r)) for c, r in damage(given).items()]
    bad = turn_repair.damaged(frame)
    got = [tuple(r) for r in turn_repair.audits(bad).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    turns = defaultdict(list)
    for r in turn_repair.repaired(bad).orderBy("place").collect():
        turns[r.conv_id].append(f"{r.role}:{r.text}")
    for row in want:
        assert hashlib.sha256("\n".join(turns[row[0]]).encode()).hexdigest() == row[-1]
    assert turn_repair.audits(bad.limit(0)).count() == turn_repair.repaired(bad.limit(0)).count() == 0
    plain = [tuple(r) for r in turn_repair.audits(frame.filter("conv_id = 2000")).collect()]
    assert plain == [(2000, *brute_report([(-5, "assistant", "a " * 300_000)]))]


def test_oracles_of_lines_and_terms(spark):
    import __spark_entry__ as entry
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in entry.oracle_sql().items():
        if name.startswith("op"):
            rel = con.sql(sql)
            rows = entry.queries()[name](spark, SF).select(rel.columns).collect()
            assert sorted(map(tuple, rows)) == sorted(rel.fetchall())

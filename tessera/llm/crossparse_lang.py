"""Operator 2: language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text accepts exactly the strings that occur in it.  A text is parsed
greedily into the longest phrases that occur in a language's training text; c phrases cost c * log2(training
length) bits, and the language that needs the fewest bits per symbol wins.

The automata are dense transition tables, and many stretches of text are parsed side by side, one symbol of each at
a time.  A stretch is at most ``STRETCH`` symbols of one text, and a phrase also ends where a stretch does, for all
languages alike; so a very long text is many short rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base

UNDETERMINED = "und"
#: Training: of every label the labelled documents whose hash is lowest, of any length, up to TRAIN_SYMBOLS symbols; of
#: one longer than PIECE symbols a stretch placed by its hash.  With very many labels each trains on fewer symbols,
#: ALL_SYMBOLS in all, and so do languages of large alphabets: the tables hold CELLS transitions at most.
TRAIN_SYMBOLS = 24_000
PIECE = TRAIN_SYMBOLS // 4
ALL_SYMBOLS, LEAST_SYMBOLS = 1_000_000, 200
CELLS = 64_000_000
#: A phrase costs as much as in a training text of this length at least: among one-symbol phrases of tiny training
#: texts the shortest text would win.
LEAST_LENGTH = 1000
STRETCH = 256


def normalise(text: str) -> str:
    """Lower case; every run of characters that are not letters is one space; no space at the ends."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


class SuffixAutomaton:
    """States as rows of transitions; state 0 is the start."""

    def __init__(self, symbols: list[int]):
        moves: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.moves = moves


class CrossParser:
    """Phrase counts of texts against the training texts of several languages."""

    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        alphabet = sorted(set("".join(training.values())) - {" "})
        code = {c: i + 2 for i, c in enumerate(alphabet)} | {" ": 0}  # 1: letters that no training text has
        # class of every code point: -1 what is no letter, else its symbol
        self.classes = np.full(0x110000, -1, np.int32)
        letters = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000 and chr(i).isalpha()]
        self.classes[letters] = 1
        for c, i in code.items():
            if c != " ":
                self.classes[ord(c)] = i
        self.bits = np.array([math.log2(max(len(training[x]), LEAST_LENGTH)) for x in self.langs])
        # a language's table has a column for each of its own symbols, and column 0 for all others
        self.column = np.zeros((len(self.langs), len(alphabet) + 2), np.int32)
        tables, starts, at = [], [], 0
        for n, lang in enumerate(self.langs):
            own = sorted({code[c] for c in training[lang]})
            self.column[n, own] = np.arange(1, len(own) + 1)
            moves = SuffixAutomaton(self.column[n, [code[c] for c in training[lang]]].tolist()).moves
            width = len(own) + 1
            # place of the next state's row * 2, plus 1 where a new phrase starts because the longer one occurs nowhere
            start = np.zeros(width, np.int32)
            for c, s in moves[0].items():
                start[c] = s * width
            table = np.broadcast_to((start + at) * 2 + 1, (len(moves), width)).copy()
            rows = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
            cols = np.array([c for m in moves for c in m], np.int64)
            table[rows, cols] = (np.array([s for m in moves for s in m.values()], np.int64) * width + at) * 2
            tables.append(table.astype(np.int32).ravel())
            starts.append(at)
            at += table.size
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.starts = np.array(starts, np.int32)

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(phrases per text and language, symbols per text); a text without letters has no symbols."""
        lowered = [t.lower() for t in texts]
        sizes = np.array([len(t) for t in lowered], np.int64)
        flat = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self.classes[flat]
        text = np.repeat(np.arange(len(texts)), sizes)
        letter = kind >= 0
        # a space goes before a letter that follows other characters within its text
        seen = np.flatnonzero(letter)
        gap = np.zeros(len(seen), bool)
        if len(seen):
            gap[1:] = (np.diff(seen) > 1) & (text[seen[1:]] == text[seen[:-1]])
        where = np.arange(len(seen)) + np.cumsum(gap)
        symbols = np.zeros(len(seen) + int(gap.sum()), np.int32)
        symbols[where] = kind[seen]
        counts = np.bincount(text[seen], minlength=len(texts)) + np.bincount(text[seen[gap]], minlength=len(texts))
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        if not len(symbols) or not self.langs:
            return total, counts
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        pieces = -(-counts // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = first[owner] + nth * STRETCH
        size = np.minimum(counts[owner] - nth * STRETCH, STRETCH)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
        state = np.repeat(self.starts[:, None], len(begin), axis=1)
        breaks = np.ones((len(self.langs), len(begin)), np.int32)
        for t, n in enumerate(active.tolist()):
            move = self.table[state[:, :n] + self.column[:, symbols[begin[:n] + t]]]
            if t:
                breaks[:, :n] += move & 1
            state[:, :n] = move >> 1
        for j in range(len(self.langs)):
            total[:, j] = np.bincount(owner, weights=breaks[j], minlength=len(texts))
        return total, counts

    def predict(self, texts: list[str]) -> tuple[list[str], list[float], list[float | None], list[int]]:
        """(language, score, bits per symbol, symbols); the score is the winner's share of 2**-bits over the languages."""
        count, symbols = self.phrases(texts)
        if not self.langs:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts), symbols.tolist()
        bits = count * self.bits
        best = bits.argmin(axis=1)  # of equal ones the first in order of name
        share = 1 / np.exp2(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
        none = symbols == 0
        return ([UNDETERMINED if x else self.langs[i] for i, x in zip(best, none)],
                np.where(none, 0.0, share).tolist(),
                [None if x else b / s for b, s, x in zip(bits.min(axis=1).tolist(), symbols.tolist(), none)],
                symbols.tolist())


def held_out(id_col: str = "doc_id", mod: int = 3):
    """True where the CRC-32 of the id as text leaves remainder 1; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(mod)) == 1


def _fitted(texts: dict[str, str]) -> dict[str, str]:
    """texts, the costliest ones cut evenly until their tables hold CELLS transitions in all."""
    def cost(text):  # an automaton has less than two states a symbol
        return 2 * len(text) * (len(set(text)) + 1)

    room, left = CELLS, sorted(texts, key=lambda x: (cost(texts[x]), x))
    out = {}
    for i, lang in enumerate(left):
        text, share = texts[lang], room // (len(left) - i)
        while cost(text) > share and len(text) > 1:
            text = text[:len(text) * 9 // 10]
        out[lang] = text
        room -= cost(text)
    return out


def training_texts(docs: DataFrame) -> dict[str, str]:
    """Per label its training text, from a bounded sample of labelled documents outside the held-out third.  The
    documents are cut before they come to the driver, about twice the symbols that train at most."""
    label, text = F.col("lang").cast("string"), F.col("text").cast("string")
    letters = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " "))
    usable = (docs.select(label.alias("lang"), letters.alias("line"),
                          F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64(text)).alias("hash"), held_out().alias("held"))
              .filter(F.col("lang").isNotNull() & ~F.col("held") & (F.length("line") > 0))
              # as many documents have fewer than b bits as have b: each level about doubles the sample
              .withColumn("level", F.length(F.bin(F.shiftrightunsigned("hash", 1)))))
    length = F.length("line").cast("bigint")
    # a table of 63 rows a label at most
    levels = (usable.groupBy("lang", "level").agg(F.sum(F.least(length, F.lit(PIECE))).alias("pieces"),
                                                  F.sum(F.least(length, F.lit(TRAIN_SYMBOLS))).alias("symbols")).collect())
    by_label: dict[str, list] = {}
    for row in sorted(levels, key=lambda r: r["level"]):
        by_label.setdefault(row["lang"], []).append(row)
    wanted = min(TRAIN_SYMBOLS, max(LEAST_SYMBOLS, ALL_SYMBOLS // max(len(by_label), 1)))
    plan = []
    for lang, rows in by_label.items():
        few = sum(r["pieces"] for r in rows) < wanted  # only with longer stretches of its documents
        total = 0
        for row in rows:
            total += row["symbols" if few else "pieces"]
            if total >= wanted:
                break
        plan.append((lang, row["level"], wanted if few else min(PIECE, wanted)))
    if not plan:
        return {}
    picked = F.broadcast(docs.sparkSession.createDataFrame(plan, "label string, most int, piece int"))  # a row a label
    found = (usable.join(picked, (F.col("lang") == F.col("label")) & (F.col("level") <= F.col("most")))
             .withColumn("begin", F.pmod(F.col("hash"), F.greatest(F.length("line") - F.col("piece"), F.lit(0)) + 1))
             .select("lang", F.substr("line", (F.col("begin") + 1).cast("int"), F.col("piece")).alias("line"), "level", "hash")
             .distinct().collect())
    parts: dict[str, list[str]] = {}
    size: dict[str, int] = {}
    for row in sorted(found, key=lambda r: (r["lang"], r["level"], r["hash"], r["line"])):
        line, own = normalise(row["line"]), parts.setdefault(row["lang"], [])
        if line and size.get(row["lang"], 0) < wanted and line not in " ".join(own):
            own.append(line)
            size[row["lang"]] = size.get(row["lang"], 0) + len(line) + 1
    return _fitted({lang: " ".join(own)[:wanted].strip() for lang, own in parts.items() if own})


def predict(docs: DataFrame, training: dict[str, str]) -> DataFrame:
    """docs with lang_pred, score, bits (per symbol) and symbols of ``text`` added; see ``identify``."""
    packed = docs.sparkSession.sparkContext.broadcast(training)
    at = docs.schema.names.index("text")

    def run(batches):
        parser = base.kept(("op2", tuple(sorted(packed.value.items()))), lambda: CrossParser(packed.value))
        for batch in batches:
            for part in base.slices(batch, 3_000_000 * 64 // max(64, len(parser.langs))):
                lang, score, bits, symbols = parser.predict([t or "" for t in part.column(at).to_pylist()])
                yield {n: part.column(n) for n in part.schema.names} | {"lang_pred": lang, "score": score, "bits": bits,
                                                                "symbols": symbols}

    from pyspark.sql.types import DoubleType, LongType, StringType, StructType
    schema = StructType([*docs.schema.fields]).add("lang_pred", StringType()).add("score", DoubleType())
    schema = schema.add("bits", DoubleType()).add("symbols", LongType())
    return base.arrow_map(docs, run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (0 to 1), bits (per symbol), symbols.

    Only text and lang of rows that are not held out teach, every label with a letter in its texts, however long or
    short they are; a prediction sees the text alone.  A text that is null
    or has no letters is ``und`` with score 0, and so is every text if no row that teaches is labelled.  Ties go to the language
    first in order of name.  Repeated rows are rows of their own; an empty table gives no rows.
    """
    training = training_texts(docs)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return predict(rows, training).drop("text")


#: A text in a learned language may cost MAX_BITS a symbol and SLACK bits besides, at every length: the bound a symbol,
#: MAX_BITS + SLACK / symbols, widens as texts get shorter and hold less evidence.  Random letters and unknown scripts
#: cost 8 to 15 a symbol, text of a learned language about 3, of two languages by turns up to 5; SLACK pays for a rare
#: name or two in a text of a few words.
MAX_BITS = 7.0
SLACK = 100.0


def in_known_language(docs: DataFrame, max_bits: float = MAX_BITS, slack: float = SLACK) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language, unchanged: rejected are null texts, texts without
    letters and those that cost more than ``max_bits`` a symbol and ``slack`` bits in every learned language.  Without
    any labelled row nothing but those without letters goes."""
    training = training_texts(docs)
    if not training:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    symbols = F.col("symbols")
    return base.shielded(docs, lambda d: predict(d.withColumn("text", F.col("text").cast("string")), training).filter(
        (F.col("lang_pred") != UNDETERMINED) & (F.col("bits") * symbols <= max_bits * symbols + slack)))


@base.register("op2_crossparse_lang")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(base.table(spark, sf_dir, "documents"))

"""Operator 5: token counts of a unigram vocabulary by a count-only Viterbi search.

An Aho-Corasick automaton of the vocabulary runs once over a word and enumerates, per end position, every piece
that ends there, longest first.  Dynamic programming keeps two numbers per position, the best score and the number
of pieces of the best path; no path is stored.

Rules that decide ties and gaps, as the unigram model of the ``tokenizers`` library has them: scores add up in
double precision from the left; of equally good paths into a position the one whose last piece starts first wins;
a character that is no piece by itself may be passed at the lowest score of the vocabulary less 10, and then counts
one token per UTF-8 byte if the vocabulary has all byte pieces, else one token for each run of such characters.
Text is split as by its Metaspace pre-tokenizer: every space starts a word and is written as the marker, and a
marker goes before the text.
"""

from __future__ import annotations

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from . import base

MODEL_FILE = "piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Words kept with their counts; emptied when fuller, which changes the time and never the result.
CACHE_WORDS = 500_000


class UnigramCounter:
    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool):
        self.byte_fallback = byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.gap = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY

    def count(self, word: str) -> int:
        """Tokens of one word (its marker included)."""
        n = len(word)
        best: list[float | None] = [None] * (n + 1)
        count = [0] * (n + 1)
        open_gap = [False] * (n + 1)  # the best path ends with a character that is no piece
        best[0] = 0.0
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(word):
            matches[end + 1].append(match)
        for e in range(1, n + 1):
            top = None
            for length, score in matches[e]:  # longest first: the earliest start comes first and keeps a tie
                s = e - length
                total = best[s] + score
                if top is None or total > top:
                    top, count[e], open_gap[e] = total, count[s] + 1, False
            c = word[e - 1]
            if c not in self.single:
                total = best[e - 1] + self.gap
                if top is None or total > top:
                    top, open_gap[e] = total, True
                    count[e] = count[e - 1] + (len(c.encode()) if self.byte_fallback else not open_gap[e - 1])
            best[e] = top
        return count[n]

    @staticmethod
    def words(text: str) -> list[str]:
        """Words with their marker; none for an empty text."""
        if not text:
            return []
        text = text.replace(" ", MARK)
        if not text.startswith(MARK):
            text = MARK + text
        return [MARK + w for w in text[1:].split(MARK)]


def load_pieces(path: str) -> tuple[list[tuple[str, float]], bool]:
    """Pieces and scores as the file has them (control and byte pieces never match text), and whether all 256 byte
    pieces are there."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return ([(model.id_to_piece(i), float(model.get_score(i))) for i in plain],
            sum(model.is_byte(i) for i in ids) == 256)


def _counter(path: str) -> tuple[UnigramCounter, dict[str, int]]:
    return base.kept(("op5", path), lambda: (UnigramCounter(*load_pieces(path)), {}))


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Per row: doc_id, n_words, n_tokens.  Null and empty texts have none; repeated rows and null ids are rows of
    their own; a very long text is one pass over its words.  The vocabulary's path is a parameter."""
    def run(batches):
        counter, known = _counter(model_path)
        for batch in batches:
            for part in base.slices(batch, 2_000_000):
                if len(known) > CACHE_WORDS:
                    known.clear()
                n_words, n_tokens = [], []
                for text in part.column("text").to_pylist():
                    words = counter.words(text or "")
                    for w in set(words).difference(known):
                        known[w] = counter.count(w)
                    n_words.append(len(words))
                    n_tokens.append(sum([known[w] for w in words]))
                yield {"doc_id": part.column("doc_id"), "n_words": n_words, "n_tokens": n_tokens}

    return base.arrow_map(base.texts(docs), run, "doc_id bigint, n_words bigint, n_tokens bigint")


@base.register("op5_unigram_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return token_counts(base.table(spark, sf_dir, "documents"), P.path(MODEL_FILE))

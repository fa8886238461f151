"""Tokenizer operators against their libraries."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import bpe_bitmap, kk_packing, unigram_count


def key(r):
    return tuple((v is None, v) for v in r)


def test_bpe_equals_tiktoken(docs, rows, none):
    import tiktoken

    path = P.path(bpe_bitmap.RANKS_FILE)
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe_bitmap.load_ranks(path), special_tokens={})
    want = []
    for i, text, _ in rows:
        ids = lib.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe_bitmap.encode_decode(docs, path, P.PATTERN).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe_bitmap.encode_decode(none, path, P.PATTERN).count() == 0


def test_rank_queue_on_long_and_repetitive_pre_tokens():
    import tiktoken

    ranks = bpe_bitmap.load_ranks(P.path(bpe_bitmap.RANKS_FILE))
    lib = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    bpe = bpe_bitmap.RankQueueBPE(ranks, P.PATTERN)
    rng = np.random.default_rng(3)
    pieces = ["a" * 999, "ab" * 700, "the" * 500, "é" * 333] + [
        "".join(rng.choice(list("abcdethnors "), 400)) for _ in range(20)]
    assert bpe.merge([p.encode() for p in pieces]) == [lib.encode_ordinary(p) for p in pieces]
    assert bpe.decode(bpe.encode("Zwölf Boxkämpfer 12!")) == "Zwölf Boxkämpfer 12!".encode()


def test_full_cache_changes_nothing():
    from tessera.llm import bpe_chunks

    made = []
    enc = bpe_chunks.ChunkEncoder(lambda cs: made.extend(cs) or [len(c) for c in cs], limit=2)
    for _ in range(3):
        assert [sum(v) for v in enc(["a bb  c", "x yy zz ww", ""])] == [7, 10, 0]


def test_new_chunks_reach_the_library_in_lines():
    import struct

    from tokenizers import Tokenizer, normalizers

    class Counting:
        def __init__(self, tok):
            self.tok, self.strings = tok, 0

        def __getattr__(self, name):
            return getattr(self.tok, name)

        def encode_batch_fast(self, texts, **options):
            self.strings += len(texts)
            return self.tok.encode_batch_fast(texts, **options)

    rng = np.random.default_rng(4)
    chunks = ["".join(rng.choice(list("abcdeéß'.12\n漢😀<|>"), rng.integers(1, 12))).strip() or "x" for _ in range(900)]
    chunks += ["<|endoftext|>", "a<|endoftext|>b", "don't", "ﬁn", "x" * 300]
    for normalizer in None, normalizers.NFKC():  # the second changes bytes, so these chunks go one by one
        tok = Tokenizer.from_file(P.path(kk_packing.TOKENIZER_FILE))
        if normalizer:
            tok.normalizer = normalizer
        want = [struct.pack(f"<{len(e.ids)}I", *e.ids)
                for e in (tok.encode(" " + c, add_special_tokens=False) for c in chunks)]
        counting = Counting(tok)
        _, spaced = kk_packing._encoders(counting)
        assert spaced(chunks) == want and spaced([]) == []
        assert normalizer or counting.strings <= len(chunks) / 20


def test_packing_holds_every_id_once(docs, rows, none):
    from tokenizers import Tokenizer

    path = P.path(kk_packing.TOKENIZER_FILE)
    lib = Tokenizer.from_file(path)
    want = Counter()
    for i, text, _ in rows:
        ids = np.array([*lib.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces = kk_packing.pack(docs, path, block=8).collect()
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at & (at - 1) == 0  # no padding
    total = Counter()
    for (i, n, _), times in want.items():
        total[i, n] += n * times
    got = Counter()
    for p in pieces:
        got[p.doc_id, p.doc_tokens] += p.length
        assert 0 <= p.start and p.start + p.length <= p.doc_tokens
    assert got == total
    one_piece = Counter((p.doc_id, p.doc_tokens, p.ids_crc32) for p in pieces if p.length == p.doc_tokens)
    assert one_piece and all(want[k] >= n for k, n in one_piece.items())
    assert kk_packing.pack(none, path).count() == 0


def test_piece_checksums(docs, rows):
    from tokenizers import Tokenizer

    path = P.path(kk_packing.TOKENIZER_FILE)
    lib = Tokenizer.from_file(path)
    ids = {i: [*lib.encode(t or "", add_special_tokens=False).ids, 1] for i, t, _ in rows if i not in (None, 140)}
    for p in kk_packing.pack(docs, path, block=8).collect():
        if p.doc_id in ids:
            part = np.array(ids[p.doc_id][p.start:p.start + p.length], "<u4")
            assert zlib.crc32(part.tobytes()) == p.ids_crc32


@pytest.mark.parametrize("k", [1, 2, 7])
def test_differencing_is_near_equal(k):
    sizes = np.random.default_rng(k).integers(1, 500, 60).tolist()
    found = kk_packing.differencing(sizes, k)
    assert sorted(i for w in found for i in w) == list(range(60))
    sums = [sum(sizes[i] for i in w) for w in found]
    assert max(sums) - min(sums) <= max(sizes)


def test_window_count_rises_with_capacity():
    found = kk_packing.windows([600, 600, 600], 1000)
    assert len(found) == 3 and kk_packing.differencing([], 3) == [[], [], []]


def test_unigram_counts_equal_the_library(docs, rows, none):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = P.path(unigram_count.MODEL_FILE)
    pieces, full = unigram_count.load_pieces(path)
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces, *((f"<0x{i:02X}>", 0.0) for i in range(256))], 0, True))
    lib.pre_tokenizer = pre_tokenizers.Metaspace()
    want = [(i, len(lib.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows]
    got = [(r.doc_id, r.n_tokens) for r in unigram_count.token_counts(docs, path).collect()]
    assert full and sorted(got, key=key) == sorted(want, key=key)
    assert unigram_count.token_counts(none, path).count() == 0


def test_unigram_ties_and_gaps():
    """Equal scores: the piece that starts first wins, as brute force over the library shows; gaps by runs."""
    from tokenizers import Tokenizer, models

    pieces = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("aba", -3.0), ("c", -5.0), ("cab", -7.0)]
    counter = unigram_count.UnigramCounter(pieces, False)
    lib = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, False))
    rng = np.random.default_rng(0)
    for _ in range(300):
        word = "".join(rng.choice(list("abcx"), rng.integers(1, 12)))
        # an unknown piece of the library stands at the score 0 of its list, ours at the least score
        if "x" not in word:
            assert counter.count(word) == len(lib.encode(word).ids), word
    assert counter.count("axxb") == 3 and counter.count("") == 0

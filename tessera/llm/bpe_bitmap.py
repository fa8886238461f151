"""Operator 6: byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Every adjacent pair of a pre-token whose bytes are in the vocabulary waits in the bucket of its rank, which holds
linked-list positions.  Three levels of 64-bit words mark the buckets that are not empty: find-first-set on each
level gives the lowest rank in constant time, so a pre-token of n bytes costs O(n log n) at worst (the order of
positions within one bucket) however long it is.  Entries that a merge made stale are skipped when they come up.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from . import base
from .bpe_chunks import ChunkEncoder

RANKS_FILE = "byte_bpe_multi_50k.tiktoken"


class RankQueueBPE:
    """Encoder and decoder for one rank table, equal to repeatedly merging the leftmost pair of lowest rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.words = {i: b for b, i in ranks.items()}
        top = max(ranks.values(), default=0)
        self.low = [0] * ((top >> 6) + 1)
        self.mid = [0] * ((top >> 12) + 1)
        self.high = 0
        self.pairs = np.full(1 << 16, -1, np.int64)
        for b, i in ranks.items():
            if len(b) == 2:
                self.pairs[b[0] << 8 | b[1]] = i

    def _mark(self, rank: int) -> None:
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.high |= 1 << (rank >> 12)

    def _next(self) -> int:
        """Find-first-set on each level: the lowest rank that waits, unmarked."""
        low, mid = self.low, self.mid
        h = (self.high & -self.high).bit_length() - 1
        m = h << 6 | (mid[h] & -mid[h]).bit_length() - 1
        bit = low[m] & -low[m]
        low[m] ^= bit
        if not low[m]:
            mid[h] &= ~(1 << (m & 63))
            if not mid[h]:
                self.high &= ~(1 << h)
        return m << 6 | bit.bit_length() - 1

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token.  All share one queue: no pair crosses from one to the next, so each gets the
        same merges as alone."""
        ranks = self.ranks
        out = [[ranks[p]] if p in ranks else None for p in pieces]
        todo = [i for i, ids in enumerate(out) if ids is None]
        data = b"".join([pieces[i] for i in todo])
        n = len(data)
        if not n:
            return [ids or [] for ids in out]
        ends = np.cumsum([len(pieces[i]) for i in todo])
        first = bytearray(n + 1)  # 1 where a pre-token starts
        for e in ends.tolist():
            first[e] = 1
        first[0] = 1
        flat = np.frombuffer(data, np.uint8).astype(np.int64)
        found = np.full(n, -1, np.int64)
        found[:-1] = self.pairs[flat[:-1] << 8 | flat[1:]]
        found[ends - 1] = -1
        waits = found.tolist()  # rank of the pair that starts here, or -1
        order = np.argsort(found, kind="stable")
        order = order[np.searchsorted(found[order], 0):]
        buckets: dict[int, list[int]] = {}
        if len(order):
            for part in np.split(order, np.flatnonzero(np.diff(found[order])) + 1):
                rank = waits[part[0]]
                buckets[rank] = part.tolist()
                self._mark(rank)
        after = list(range(1, n + 2))  # start of the next symbol
        before = list(range(-1, n))
        get, mark, find = ranks.get, self._mark, self._next
        while self.high:
            rank = find()
            bucket = buckets.pop(rank)
            bucket.sort()
            for at, i in enumerate(bucket):
                if waits[i] != rank:
                    continue  # stale
                j = after[i]
                k = after[i] = after[j]
                waits[j] = -1
                least = rank
                if first[k]:
                    waits[i] = -1
                else:
                    before[k] = i
                    r = get(data[i:after[k]])
                    if r is None:
                        waits[i] = -1
                    else:
                        waits[i] = r
                        if r in buckets:
                            buckets[r].append(i)
                        else:
                            buckets[r] = [i]
                            mark(r)
                        if r < least:
                            least = r
                if not first[i]:
                    p = before[i]
                    r = get(data[p:k])
                    if r is None:
                        waits[p] = -1
                    else:
                        waits[p] = r
                        if r in buckets:
                            buckets[r].append(p)
                        else:
                            buckets[r] = [p]
                            mark(r)
                        if r < least:
                            least = r
                if least < rank:  # a lower rank came up: it goes before the rest of this bucket
                    if rest := bucket[at + 1:]:
                        buckets[rank] = rest
                        mark(rank)
                    break
        i = 0
        for t, e in zip(todo, ends.tolist()):
            ids = out[t] = []
            while i < e:
                k = after[i]
                ids.append(ranks[data[i:k]])
                i = k
        return out

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.merge([m.encode() for m in self.pattern.findall(text)]) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _codec(path: str, pattern: str) -> tuple[ChunkEncoder, RankQueueBPE]:
    """One per worker process, so that its cache serves all its tasks."""
    def make():
        bpe = RankQueueBPE(load_ranks(path), pattern)
        pieces: dict[str, list[int]] = {}

        def many(chunks):
            if len(pieces) > 300_000:
                pieces.clear()
            cut = [bpe.pattern.findall(c) for c in chunks]
            new = list(set().union(*cut).difference(pieces))
            pieces.update(zip(new, bpe.merge([m.encode() for m in new])))
            return [",".join([str(i) for m in ms for i in pieces[m]]) for ms in cut]

        return ChunkEncoder(many), bpe

    return base.kept(("op6", path, pattern), make)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (decimal ids joined by commas), decoded_sha256 (bytes decoded from
    the ids).  A null text counts as empty: no ids, digests of nothing.  Repeated rows and null ids stay rows of
    their own; the vocabulary file's path is a parameter and the file must exist on every executor.
    """
    def run(batches):
        codec, bpe = _codec(ranks_path, pattern)
        word = {str(i): b for i, b in bpe.words.items()}.__getitem__
        for batch in batches:
            for part in base.slices(batch, 2_000_000):
                joined = [",".join(filter(None, ids)) for ids in codec([t or "" for t in part.column("text").to_pylist()])]
                ids = [j.split(",") if j else [] for j in joined]
                yield {"doc_id": part.column("doc_id"),
                       "n_tokens": list(map(len, ids)),
                       "ids_sha256": [hashlib.sha256(j.encode()).hexdigest() for j in joined],
                       "decoded_sha256": [hashlib.sha256(b"".join(map(word, i))).hexdigest() for i in ids]}

    return base.arrow_map(base.texts(docs), run,
                          "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@base.register("op6_bpe_rank_queue")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return encode_decode(base.table(spark, sf_dir, "documents"), P.path(RANKS_FILE), P.PATTERN)

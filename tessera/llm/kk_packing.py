"""Operator 4: packing token ids into windows by Karmarkar-Karp multiway differencing.

Documents are tokenized where they are read, and each task packs what it reads; nothing is shuffled, so no key can
be hot.  A document longer than a window gives full windows at once; what is left over is packed in blocks.  In a
block every leftover starts as a partial partition of k windows with one of them filled; the two partial partitions
with the widest imbalance are merged, fullest windows against emptiest, until one is left.  If a window then exceeds
the capacity, k rises and the block is done again.  Documents may be cut, so the emptiest windows are dissolved to
top up the near-equal rest, and what remains moves into the next block.  A task's last remainder is written as
sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import heapq
import os
import struct
import zlib
from itertools import chain

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import base
from .bpe_chunks import ChunkEncoder

TOKENIZER_FILE = "byte_bpe_50k.json"
WINDOW = 2048
END_ID = 1
#: Leftovers packed together; bounds a task's memory and the differencing's work.
BLOCK_ITEMS = 256
#: Encoded chunks that a worker keeps (about 200 bytes each): the library takes longest for new ones.
CACHE_CHUNKS = 650_000
#: New chunks that the library gets in one string, and in one call.
LINE_CHUNKS, CHUNKS_AT_ONCE = 40, 20_000


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Split the items into k windows of near-equal sums: indexes of the items per window (some may be empty)."""
    heap: list = []
    for i, s in enumerate(sizes):
        load = np.zeros(k, np.int64)
        load[0] = s
        heap.append((-s, i, load, [(i,)] + [()] * (k - 1)))
    if not heap:
        return [[] for _ in range(k)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a, own = heapq.heappop(heap)
        _, _, b, other = heapq.heappop(heap)
        load = a + b[::-1]
        order = np.argsort(-load, kind="stable")
        load = load[order]
        load -= load[-1]
        other.reverse()
        members = [own[j] + other[j] for j in order.tolist()]
        heapq.heappush(heap, (-int(load[0]), n, load, members))
        n += 1
    return [list(m) for m in heap[0][3]]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """Differencing with as few windows as the capacity allows; the count rises whenever it is exceeded."""
    total = sum(sizes)
    k = max(1, -(-total // capacity))
    while True:
        found = differencing(sizes, k)
        over = max(sum(sizes[i] for i in w) for w in found)
        if over <= capacity:
            return [w for w in found if w]
        k = min(max(k + 1, k * over // capacity), len(sizes))


def pack_block(items: list[tuple], capacity: int, last: bool) -> tuple[list[list[tuple]], list[tuple]]:
    """items: (document, start, length) with length <= capacity.  Gives sequences of pieces, and the remainder
    (pieces for the next block; empty if ``last``)."""
    if not items:
        return [], []
    packed = [[items[i] for i in w] for w in windows([x[2] for x in items], capacity)]
    fill = [sum(x[2] for x in w) for w in packed]
    full = sum(fill) // capacity
    order = sorted(range(len(packed)), key=lambda j: -fill[j])
    loose = [x for j in order[full:] for x in packed[j]]
    out = []
    for j in order[:full]:
        out.append(packed[j] + _take(loose, capacity - fill[j]))
    if not last:
        return out, loose
    rest = sum(x[2] for x in loose)
    while rest:
        out.append(_take(loose, n := 1 << rest.bit_length() - 1))
        rest -= n
    return out, []


def _take(loose: list[tuple], n: int) -> list[tuple]:
    """Cut n tokens off the end of the list of pieces."""
    got = []
    while n:
        doc, start, length = loose.pop()
        if length > n:
            loose.append((doc, start, length - n))
            start, length = start + length - n, n
        got.append((doc, start, length))
        n -= length
    return got


def _encoders(tok):
    """Two functions of a list of chunks that give each one's ids as bytes: for any chunks, and for chunks that follow
    a lone space.  The latter are put together to lines, since a call of the library costs more than the chunk in it;
    the numbers of bytes that the ids stand for tell where each chunk ends."""
    size = np.zeros(tok.get_vocab_size(), np.int64)
    for token, i in tok.get_vocab(with_added_tokens=False).items():
        size[i] = len(token)  # byte-level: a character for each byte
    for i, token in tok.get_added_tokens_decoder().items():
        size[i] = len(token.content.encode())
    if hasattr(tok.model, "_resize_cache"):
        tok.model._resize_cache(0)  # the library sees each chunk once, its own cache only takes time

    def many(chunks):
        return [struct.pack(f"<{len(e)}I", *e.ids) for e in tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def spaced(chunks):
        out = []
        for at in range(0, len(chunks), CHUNKS_AT_ONCE):
            part = chunks[at:at + CHUNKS_AT_ONCE]
            lines = [" " + " ".join(part[i:i + LINE_CHUNKS]) for i in range(0, len(part), LINE_CHUNKS)]
            found = tok.encode_batch_fast(lines, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), "<u4", sum(map(len, found)))
            ends = np.cumsum(size[ids])
            stops = np.cumsum(np.fromiter((len(c.encode()) for c in part), np.int64, len(part)) + 1)
            last = np.searchsorted(ends, stops)
            if not len(ids) or ends[-1] != stops[-1] or (ends[last] != stops).any():  # ids are not the bytes they come from
                out += many([" " + c for c in part])
                continue
            last = (4 * (last + 1)).tolist()
            ids = ids.tobytes()
            out += [ids[a:b] for a, b in zip([0, *last], last)]
        return out

    return many, spaced


def _encoder(path: str) -> ChunkEncoder:
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer
        many, spaced = _encoders(Tokenizer.from_file(path))
        return ChunkEncoder(many, CACHE_CHUNKS, spaced)

    return base.kept(("op4", path), make)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = WINDOW, end_id: int = END_ID,
         block: int = BLOCK_ITEMS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document (its ids, then ``end_id``) lies in exactly one piece.  A sequence is full, or its
    length is a power of two, so none is padded.  Null and empty texts give the end id alone; repeated rows and
    null ids are packed like any other; an empty table gives no rows.
    """
    def run(batches):
        encode = _encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 32
        held: dict[int, tuple] = {}  # documents with pieces not yet out
        loose: list[tuple] = []
        count = 0

        def rows(sequences):
            nonlocal sequence
            cols: dict[str, list] = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                     "sequence_id", "offset")}
            for pieces in sequences:
                at = 0
                for doc, start, length in pieces:
                    doc_id, ids = held[doc]
                    for c, v in zip(cols.values(), (doc_id, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                                    len(ids) // 4, sequence, at)):
                        c.append(v)
                    at += length
                sequence += 1
            return cols

        for batch in batches:
            for part in base.slices(batch, 2_000_000):
                done: list[list[tuple]] = []
                for doc_id, values in zip(part.column("doc_id").to_pylist(),
                                          encode([t or "" for t in part.column("text").to_pylist()])):
                    ids = memoryview(b"".join(values) + end)
                    held[count] = doc_id, ids
                    n = len(ids) // 4
                    whole = n - n % capacity
                    done += [[(count, s, capacity)] for s in range(0, whole, capacity)]
                    if whole < n:
                        loose.append((count, whole, n - whole))
                    count += 1
                    if len(loose) >= block:
                        got, loose = pack_block(loose, capacity, last=False)
                        done += got
                yield rows(done)
                waiting = {x[0] for x in loose}
                held = {d: v for d, v in held.items() if d in waiting}
        got, _ = pack_block(loose, capacity, last=True)
        yield rows(got)

    return base.arrow_map(base.texts(docs), run, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, "
                                                 "doc_tokens bigint, sequence_id bigint, offset bigint")


@base.register("op4_kk_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return pack(base.table(spark, sf_dir, "documents"), P.path(TOKENIZER_FILE))

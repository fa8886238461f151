"""Chunk-wise application of byte-level tokenizers with a bounded cache.

A lone space between two characters that are not white space always starts a new match of the pre-tokenizing
pattern, whatever surrounds it.  So a text may be cut before each such space and every chunk encoded by itself;
the same chunks come again and again, so a dictionary lookup replaces most encoding.  Chunks next to any other
white space stay together with their neighbours.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence
from typing import Any

#: Chunks kept.  A full cache takes no more chunks for FROZEN_CALLS calls and then starts empty; that changes the
#: time and never the result.
CACHE_CHUNKS = 500_000
FROZEN_CALLS = 500


class ChunkEncoder:
    """``encode_many(list of str) -> list of values`` applied per chunk, values concatenated by the caller.
    ``encode_spaced`` gives the values of chunks that follow a lone space, which is not in the list."""

    def __init__(self, encode_many: Callable[[Sequence[str]], Sequence[Any]], limit: int = CACHE_CHUNKS,
                 encode_spaced: Callable[[Sequence[str]], Sequence[Any]] | None = None):
        self.encode_many, self.limit = encode_many, limit
        self.encode_spaced = encode_spaced or (lambda chunks: encode_many([" " + c for c in chunks]))
        self.frozen = 0
        self.spaced: dict[str, Any] = {}  # chunk without the space before it; None: white space at an end

    def __call__(self, texts: Sequence[str]) -> list[list[Any]]:
        """Per text the values of its chunks, in order.  Nothing here makes cycles, and the collector would walk
        through the cache again and again: it is off meanwhile."""
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encoded(texts)
        finally:
            if collecting:
                gc.enable()

    def _encoded(self, texts: Sequence[str]) -> list[list[Any]]:
        spaced = self.spaced
        full = len(spaced) > self.limit
        self.frozen += full
        if self.frozen > FROZEN_CALLS:
            spaced.clear()
            self.frozen, full = 0, False
        split = [t.split(" ") for t in texts]
        unseen: set[str] = set()
        out, gaps = [], []
        for parts in split:
            values = list(map(spaced.get, parts))
            missing = [] if all(values) else [j for j, v in enumerate(values) if not v]
            unseen.update([parts[j] for j in missing])
            out.append(values)
            gaps.append(missing)
        new = [p for p in unseen if p not in spaced]
        sound = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        spaced.update(dict.fromkeys(new))
        spaced.update(zip(sound, self.encode_spaced(sound), strict=True))
        for parts, values, missing in zip(split, out, gaps):
            for j in missing:
                values[j] = spaced[parts[j]]
            if None in map(values.__getitem__, missing):
                values.clear()
        heads: list[str] = []
        places: list[tuple[int, int]] = []
        for i in range(len(out)):
            if out[i]:
                heads.append(split[i][0])  # has no space before it
                places.append((i, 0))
                continue
            values = []
            for glued, text in _segments(split[i]):
                if glued:
                    places.append((i, len(values)))
                    heads.append(text)
                    values.append(None)
                else:
                    values.append(spaced[text])
            out[i] = values
        for (i, j), v in zip(places, self.encode_many(heads), strict=True):
            out[i][j] = v
        if full:
            for p in new:
                del spaced[p]
        return out


def _segments(parts: list[str]):
    """(True, whole segment) or (False, one sound chunk after a lone space)."""
    def sound(p):
        return bool(p) and not p[0].isspace() and not p[-1].isspace()

    def ends(p):
        return bool(p) and not p[-1].isspace()

    def starts(p):
        return bool(p) and not p[0].isspace()

    run = parts[0]
    plain = False  # run is one sound chunk that follows a lone space
    for before, p in zip(parts, parts[1:]):
        if ends(before) and starts(p):
            yield (False, run) if plain else (True, run)
            run, plain = (p, True) if sound(p) else (" " + p, False)
        else:
            run, plain = ((" " + run) if plain else run) + " " + p, False
    yield (False, run) if plain else (True, run)

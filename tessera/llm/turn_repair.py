"""Operator 11: repair of conversations by the cheapest edits, with an audit string of what was done.

A repaired conversation is empty or an optional system turn followed by pairs of user and assistant.  A dynamic
program over the rows keeps, for each of the four places in that pattern, the cheapest edits so far.  The edits are
not kept as strings: each is a node that points to the one before, so the four share their prefixes.  A node also has
ancestors at distances of powers of two and a rolling hash of all letters up to it; edits of equal cost are compared
by searching their longest common prefix through these, and an equality of hashes that decides is verified letter by
letter.

Rows pass by in order.  Whenever the four edits agree on a prefix, its rows are settled: they go out, and their nodes
and texts are given up.  So a conversation is streamed, not collected; besides the undecided rows a task holds one
16-byte key for each distinct (role, text) of the conversation at hand.
"""

from __future__ import annotations

import hashlib
import itertools
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import base

# --- fixed values -------------------------------------------------------------
SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
# ------------------------------------------------------------------------------
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a kept row's initial makes of a place in the pattern.
KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: The place after a turn that is given its role: only one role fits.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
PRIME, FACTOR = (1 << 61) - 1, 9_113_823_231
#: Nodes, and bytes of undecided texts, from which the common prefix is looked for.
NODES, HELD = 4096, 4 << 20


class Edits:
    """Strings of edits that share their prefixes; node 0 is the prefix already given out."""

    def __init__(self):
        self.clear(0, 0)

    def clear(self, depth: int, digest: int):
        self.letter, self.depth, self.hash, self.up = [""], [depth], [digest], [[]]

    def add(self, parent: int, letter: str) -> int:
        up, k = [parent], 0
        while len(self.up[up[k]]) > k:
            up.append(self.up[up[k]][k])
            k += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * FACTOR + ord(letter)) % PRIME)
        self.up.append(up)
        return len(self.up) - 1

    def ancestor(self, node: int, depth: int) -> int:
        while (gap := self.depth[node] - depth) > 0:
            node = self.up[node][gap.bit_length() - 1]
        return node

    def path(self, node: int, top: int = 0) -> str:
        out = []
        while node != top:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))

    def same(self, a: int, b: int) -> bool:
        """Letter by letter, whether two nodes of one depth spell the same."""
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, x: str, b: int, y: str) -> bool:
        """Whether the letters up to node a and then x sort before those up to b and then y."""
        if a == b:
            return x < y
        depth = min(self.depth[a], self.depth[b])
        p, q = self.ancestor(a, depth), self.ancestor(b, depth)
        if self.hash[p] == self.hash[q]:
            if not self.same(p, q):
                return self.path(a) + x < self.path(b) + y
            x, y = (z if self.depth[n] == depth else self.letter[self.ancestor(n, depth + 1)] for n, z in ((a, x), (b, y)))
            return x < y or (x == y and self.depth[a] < self.depth[b])
        for k in range(len(self.up[p]) - 1, -1, -1):
            if k < len(self.up[p]) and self.hash[self.up[p][k]] != self.hash[self.up[q][k]]:
                p, q = self.up[p][k], self.up[q][k]
        if not self.same(self.up[p][0], self.up[q][0]):  # two prefixes of one hash
            return self.path(a) + x < self.path(b) + y
        return self.letter[p] < self.letter[q]

    def common(self, nodes: list[int]) -> int:
        """The deepest node on the way to all of ``nodes``."""
        out = nodes[0]
        for node in nodes[1:]:
            depth = min(self.depth[out], self.depth[node])
            out, node = self.ancestor(out, depth), self.ancestor(node, depth)
            while out != node:
                k = max((k for k in range(len(self.up[out])) if self.up[out][k] != self.up[node][k]), default=0)
                out, node = self.up[out][k], self.up[node][k]
        return out

    def rooted(self, root: int, nodes: list[int]) -> list[int]:
        """Give up all but the ways from ``root`` to ``nodes``; returns their new numbers."""
        live = set()
        for node in nodes:
            while node != root and node not in live:
                live.add(node)
                node = self.up[node][0]
        old = sorted(live)
        letters, parents = [self.letter[n] for n in old], [self.up[n][0] for n in old]
        self.clear(self.depth[root], self.hash[root])
        number = {root: 0}
        for n, letter, parent in zip(old, letters, parents, strict=True):
            number[n] = self.add(number[parent], letter)
        return [number[n] for n in nodes]


class Conversation:
    """Takes the rows of one conversation in order; ``out`` gets (edit, role, text) of each turn that stays."""

    def __init__(self, out, nodes: int = NODES, held: int = HELD):
        self.out, self.nodes, self.held = out, nodes, held
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.first_turn = self.last_turn = self.last_initial = None
        self.seen = set()
        self.edits = Edits()
        self.best = {START: (0, 0)}  # place -> cost, node
        self.rows, self.bytes, self.limit = deque(), 0, nodes
        self.place, self.audit = START, []

    def add(self, turn: int | None, role: str, text: str):
        if turn is not None:
            if self.n_turns == 0:
                self.first_turn = turn
            self.n_turns += self.n_turns == 0 or turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial = initial
        body = text.rstrip(SPACE)
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        blank, duplicate = not body, key in self.seen
        self.seen.add(key)
        truncated = not blank and not duplicate and body[-1] not in ENDS
        self.blank += blank
        self.duplicate += duplicate and not blank
        self.truncated += truncated
        gone = blank or duplicate
        self.rows.append(None if gone else (role, text))
        self.bytes += 0 if gone else len(text)
        self._insert()
        self._row("" if gone else initial, gone, TRUNCATED_COST * truncated)
        if len(self.edits.up) >= self.limit or self.bytes >= self.held:
            self._settle()

    def _offer(self, best: dict, place: int, cost: int, parent: int, letter: str):
        """Note a way to ``place`` as (cost, parent, letter) if it is the best so far."""
        other = best.get(place)
        if other is None or cost < other[0] or (cost == other[0] and self.edits.less(parent, letter, *other[1:])):
            best[place] = (cost, parent, letter)

    def _before(self, a: int, b: int) -> bool:
        edits = self.edits
        return edits.less(edits.up[a][0], edits.letter[a], edits.up[b][0], edits.letter[b]) if a and b else a < b

    def _insert(self):
        """An inserted turn takes USER to ASSISTANT and all else to USER.  Taken in this order, two in one gap are
        found too; three never help."""
        for sources, place in (((START, SYSTEM, ASSISTANT), USER), ((USER,), ASSISTANT)):
            found: dict = {}
            for source in sources:
                if source in self.best:
                    cost, node = self.best[source]
                    self._offer(found, place, cost + INSERT_COST, node, INSERT)
            if not found:
                continue
            cost, parent, letter = found[place]
            now = self.best.get(place)
            node = self.edits.add(parent, letter)
            if now is None or cost < now[0] or (cost == now[0] and self._before(node, now[1])):
                self.best[place] = (cost, node)

    def _row(self, initial: str, gone: bool, extra: int):
        found: dict = {}
        for place, (cost, node) in self.best.items():
            self._offer(found, place, cost + DELETE_COST, node, DELETE)
            if gone:
                continue
            kept = KEPT.get(initial, {}).get(place)
            if kept is not None:
                self._offer(found, kept, cost + extra, node, KEEP)
            if kept != NEXT[place]:  # a new role for its own costs more than keeping it
                self._offer(found, NEXT[place], cost + extra + REROLE_COST, node, REROLE)
        if ASSISTANT in found:
            # whatever can follow START or SYSTEM can follow ASSISTANT, at DELETE_COST more where START keeps an s
            least = found[ASSISTANT][0]
            for place, more in ((START, DELETE_COST), (SYSTEM, 0)):
                if place in found and least + more < found[place][0]:
                    del found[place]
        self.best = {p: (cost, self.edits.add(parent, letter)) for p, (cost, parent, letter) in found.items()}

    def _settle(self):
        nodes = [n for _, n in self.best.values()]
        root = self.edits.common(nodes)
        self._give_out(self.edits.path(root))
        nodes = self.edits.rooted(root, nodes)
        self.best = {p: (cost, n) for (p, (cost, _)), n in zip(self.best.items(), nodes, strict=True)}
        self.limit = max(self.nodes, 2 * len(self.edits.up))
        self.held = max(HELD, 2 * self.bytes)

    def _give_out(self, letters: str):
        self.audit.append(letters)
        for letter in letters:
            role, text = None, ""
            if letter != INSERT:
                row = self.rows.popleft()
                if row is not None:
                    role, text = row
                    self.bytes -= len(text)
                if letter == DELETE:
                    continue
            if letter == KEEP:
                self.place = KEPT[role[:1]][self.place]
            else:
                self.place = NEXT[self.place]
                role = NAMES[self.place]
            self.out(letter, role, text)

    def end(self) -> dict:
        self._insert()
        ways = [self.best[p] for p in (START, ASSISTANT) if p in self.best]
        cost, node = ways[0]
        for other, n in ways[1:]:
            if other < cost or (other == cost and self._before(n, node)):
                cost, node = other, n
        self._give_out(self.edits.path(node))
        gaps = self.last_turn - self.first_turn + 1 - self.n_turns if self.n_turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": cost, "audit": "".join(self.audit)}


def _in_order(turns: DataFrame) -> DataFrame:
    """Rows dealt by conversation and sorted: turn (null first), role, text.  Null roles and texts are one blank."""
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")}
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        blank["role"].alias("role"), blank["text"].alias("text"), copies.cast("int").alias("copies"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches, start, end, flush=lambda: ()):
    """Calls ``start(conv_id)`` for a Conversation when an id begins, and yields ``end(conv_id, conversation)`` after
    its last row and what ``flush()`` has after each slice of rows."""
    now, conversation = None, None
    for batch in batches:
        for part in base.slices(batch, 4 << 20):
            for conv_id, turn, role, text, copies in zip(*(part.column(c).to_pylist() for c in (
                    "conv_id", "turn", "role", "text", "copies")), strict=True):
                if conversation is None or conv_id != now:
                    if conversation is not None:
                        yield end(now, conversation)
                    now, conversation = conv_id, start(conv_id)
                for _ in range(copies):
                    conversation.add(turn, role, text)
            yield from flush()
    if conversation is not None:
        yield end(now, conversation)
    yield from flush()


class _Digest:
    """SHA-256 of ``role:text`` lines."""

    def __init__(self):
        self.sha, self.any = hashlib.sha256(), False

    def __call__(self, edit: str, role: str, text: str):
        self.sha.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any = True


def _by_column(rows: list[dict]) -> dict:
    return {k: [r[k] for r in rows] for k in rows[0]}


REPORT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
          "audit string, repaired_sha256 string")


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost, audit string and the digest of the repaired turns.

    ``turns`` has conv_id, turn, role, text and may have ``copies``: how often a row stands, where 0 leaves only its
    conversation, which then may have no rows at all.  Null ids are one conversation.  Rows of one turn are taken by
    role, then text; repeated rows are duplicates.  A role may be any string: only its first character counts.  Other
    columns are left behind; an empty table gives no rows.
    """
    def fn(batches):
        rows: list[dict] = []

        def start(_):
            return Conversation(_Digest())

        def end(conv_id, conversation):
            return {"conv_id": conv_id, **conversation.end(), "repaired_sha256": conversation.out.sha.hexdigest()}

        for row in _conversations(batches, start, end):
            rows.append(row)
            if len(rows) == 1000:
                yield _by_column(rows)
                rows = []
        if rows:
            yield _by_column(rows)

    return base.arrow_map(_in_order(turns), fn, REPORT)


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired turns themselves: conv_id, place (from 0), edit (K, R or I), role, text.  Takes what ``audits``
    takes; a conversation that loses all its rows has none."""
    def fn(batches):
        out: list[dict] = []

        def start(conv_id):
            places = itertools.count()
            return Conversation(lambda edit, role, text: out.append(
                {"conv_id": conv_id, "place": next(places), "edit": edit, "role": role, "text": text}))

        def flush():
            if out:
                yield _by_column(out)
                out.clear()

        for cols in _conversations(batches, start, lambda _, conversation: conversation.end(), flush):
            if "edit" in cols:  # not the report of a conversation
                yield cols

    return base.arrow_map(_in_order(turns), fn, "conv_id bigint, place bigint, edit string, role string, text string")


def damaged(turns: DataFrame) -> DataFrame:
    """Known damage for the query: by crc32 of ``conv_id:turn`` modulo 20, 0 drops a row (``copies`` 0), 1 empties its
    text, 2 takes out its sentence ends, 3 repeats it, 4 makes it the user's."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")), F.lit(20))
    return turns.withColumn("_kind", kind).select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 0, "").when(F.col("_kind") == 4, "user").otherwise(text("role")).alias("role"),
        F.when(F.col("_kind").isin(0, 1), "").when(F.col("_kind") == 2, F.translate(text("text"), ENDS, ""))
        .otherwise(text("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).alias("copies"))


@base.register("op11_turn_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(base.table(spark, sf_dir, "conversations")))

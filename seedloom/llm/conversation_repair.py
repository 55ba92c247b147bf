"""Cheapest repair of damaged conversations, with an audit of its edits.

The turns of a conversation, by ``turn`` (nulls first, ties by role, then text), are edited so
that their role initials read ``(s?(ua)+)?``: Keep, Rerole to user or assistant, Delete, and
Insert of an empty turn. Blank and duplicate turns have to go, a truncated one costs extra while
it stays. The audit is the edits' initials; among repairs of least cost the ASCII-least audit wins.

The search keeps the best edit list for each of four states of that pattern. Edit lists are
persistent: a node holds its last edit and its parent, so lists share their beginnings, and a step
adds a few nodes. Ties are settled by the longest common prefix of two lists, found over
binary-lifted ancestors by rolling hash; the prefixes are then compared edit by edit (they meet in
one node at once unless two hashes collide). Conversations that look alike (role initials and
faults) share one search.

Conversations are dealt by id, sorted by Spark (which spills) and streamed through the tasks. In a
long one, edits on which all live lists agree are settled as it goes: their turns leave memory, and
their nodes too. What stays is a digest per turn, to see duplicates, and a byte of audit per
edit. The digest of the repaired text runs over it in order, so one task has to pass over a
conversation; nothing holds it whole.

Defined cases: a null role or text is one space; null ids form one conversation; an empty text is
blank; very long texts are ordinary turns; rows that repeat are duplicates; a conversation without
turns (all marked as absent) has zeros, an empty audit and the digest of nothing; an empty
table gives no row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INSERT, DELETE, REROLE, TRUNCATED = 3, 4, 3, 3
#: Conversations of at most so many turns are searched by what they look like, and remembered.
SHORT = 48
#: Turns of a longer conversation between two attempts to settle edits.
SETTLE_EVERY = 2_000
REMEMBERED = 200_000

_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_KEEPS = {"s": ((_START,), _SYSTEM), "u": ((_START, _SYSTEM, _ASSISTANT), _USER), "a": ((_USER,), _ASSISTANT)}
_REROLES = (((_START, _SYSTEM, _ASSISTANT), _USER), ((_USER,), _ASSISTANT))
_MODULUS, _BASE = (1 << 61) - 1, 911_382_323


class EditLists:
    """Persistent lists of edits as nodes of a tree; node 0 is the empty list."""

    def __init__(self):
        self.parent, self.edit, self.depth, self.hash = [0], [""], [0], [0]
        self.ancestors: list[list[int]] = [[]]  # ancestors[x][k] is 2**k edits shorter

    def add(self, parent: int, edit: str) -> int:
        node = len(self.parent)
        self.parent.append(parent)
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(edit)) % _MODULUS)
        lifted, k = [parent], 0
        while len(self.ancestors[lifted[k]]) > k:
            lifted.append(self.ancestors[lifted[k]][k])
            k += 1
        self.ancestors.append(lifted)
        return node

    def up(self, node: int, steps: int) -> int:
        while steps:
            k = steps.bit_length() - 1
            node = self.ancestors[node][k]
            steps -= 1 << k
        return node

    def same(self, x: int, y: int) -> bool:
        """Whether two lists of one length are equal, edit by edit."""
        while x != y:
            if self.edit[x] != self.edit[y]:
                return False
            x, y = self.parent[x], self.parent[y]
        return True

    def less(self, x: int, y: int) -> bool:
        """Whether list x comes before list y."""
        least = min(self.depth[x], self.depth[y])
        a, b = self.up(x, self.depth[x] - least), self.up(y, self.depth[y] - least)
        if self.hash[a] == self.hash[b] and self.same(a, b):
            return self.depth[x] < self.depth[y]
        for k in reversed(range(len(self.ancestors[a]))):
            if k < len(self.ancestors[a]):
                up_a, up_b = self.ancestors[a][k], self.ancestors[b][k]
                if self.hash[up_a] != self.hash[up_b]:
                    a, b = up_a, up_b
        if self.edit[a] == self.edit[b] or not self.same(self.parent[a], self.parent[b]):
            return self.edits(x) < self.edits(y)  # a collision of hashes
        return self.edit[a] < self.edit[b]

    def edits(self, node: int, root: int = 0) -> str:
        found = []
        while node != root:
            found.append(self.edit[node])
            node = self.parent[node]
        return "".join(reversed(found))

    def common(self, nodes: list[int]) -> int:
        """Deepest node that all given lists go through."""
        found = nodes[0]
        for node in nodes[1:]:
            a, b = found, node
            least = min(self.depth[a], self.depth[b])
            a, b = self.up(a, self.depth[a] - least), self.up(b, self.depth[b] - least)
            for k in reversed(range(len(self.ancestors[a]))):
                if k < len(self.ancestors[a]) and self.ancestors[a][k] != self.ancestors[b][k]:
                    a, b = self.ancestors[a][k], self.ancestors[b][k]
            found = a if a == b else self.parent[a]
        return found


class AuditSearch:
    """Cheapest edit list per state after each turn.

    A turn is one letter: the initial ``s``, ``u`` or ``a`` of its role, ``x`` for another one, in
    upper case if it is truncated; or ``d`` if it has to go.
    """

    def __init__(self):
        self.lists = EditLists()
        self.states: list[tuple[int, int] | None] = [(0, 0), None, None, None]

    def _best(self, options: list[tuple[int, int, str]], stays: tuple[int, int] | None = None):
        """Cheapest of (cost, list, edit) and a list as it is; the least list among equals."""
        costs = [cost for cost, _, _ in options] + ([stays[0]] if stays else [])
        if not costs:
            return None
        least = min(costs)
        nodes = [self.lists.add(node, edit) for cost, node, edit in options if cost == least]
        if stays and stays[0] == least:
            nodes.append(stays[1])
        best = nodes[0]
        for node in nodes[1:]:
            if self.lists.less(node, best):
                best = node
        return least, best

    def _with_inserts(self) -> list[tuple[int, int] | None]:
        states = list(self.states)
        for sources, to in _REROLES:  # the turn a state waits for may be put in
            options = [(states[s][0] + INSERT, states[s][1], "I") for s in sources if states[s]]
            states[to] = self._best(options, states[to])
        return states

    def step(self, turn: str) -> None:
        before, moves = self._with_inserts(), [[] for _ in range(4)]
        for state, reached in enumerate(before):
            if reached:
                moves[state].append((reached[0] + DELETE, reached[1], "D"))
        if turn != "d":
            extra = TRUNCATED if turn.isupper() else 0
            ways = [(*move, extra + REROLE, "R") for move in _REROLES]
            if turn.lower() in _KEEPS:
                ways.append((*_KEEPS[turn.lower()], extra, "K"))
            for sources, to, cost, edit in ways:
                moves[to] += [(before[s][0] + cost, before[s][1], edit) for s in sources if before[s]]
        self.states = [self._best(options) for options in moves]
        self._drop_hopeless()

    def _drop_hopeless(self) -> None:
        """Forget states that a cheaper one can stand in for, whatever follows.

        After an assistant's turn every edit is open that is open after a system turn or at the
        start, but for keeping a system turn, which a deletion replaces; an insert leads from a
        user's to an assistant's turn and back.
        """
        endless = 1 << 60
        user, assistant = (reached[0] if reached else endless for reached in self.states[_USER:])
        user, assistant = min(user, assistant + INSERT), min(assistant, user + INSERT)
        for state, most in enumerate((assistant + DELETE, assistant, user, assistant)):
            if self.states[state] and self.states[state][0] > most:
                self.states[state] = None

    def settle(self) -> str:
        """Edits that every live list begins with; they leave the lists."""
        live = [reached[1] for reached in self.states if reached]
        root = self.lists.common(live)
        settled, kept, places = self.lists.edits(root), EditLists(), {root: 0}
        for node in live:
            path = []
            while node not in places:
                path.append(node)
                node = self.lists.parent[node]
            for step in reversed(path):
                places[step] = kept.add(places[self.lists.parent[step]], self.lists.edit[step])
        self.states = [(reached[0], places[reached[1]]) if reached else None for reached in self.states]
        self.lists = kept
        return settled

    def finish(self) -> tuple[int, str]:
        """Cost of the whole repair, and its edits that are not settled yet."""
        states = self._with_inserts()
        ends = [states[s] for s in (_START, _ASSISTANT) if states[s]]
        best = ends[0]
        for end in ends[1:]:
            if end[0] < best[0] or (end[0] == best[0] and self.lists.less(end[1], best[1])):
                best = end
        return best[0], self.lists.edits(best[1])


@lru_cache(REMEMBERED)
def cheapest_audit(turns: str) -> tuple[int, str]:
    """Cost and audit of a conversation given by one letter a turn (see ``AuditSearch``)."""
    search = AuditSearch()
    for turn in turns:
        search.step(turn)
    return search.finish()


#: Called with edit, turn number, role and text of each turn, in order; role is null if it is deleted.
Sink = Callable[[str, int | None, str | None, str], None]


class Conversation:
    """One conversation as its turns stream by."""

    def __init__(self, sink: Sink):
        self.sink, self.search, self.audit = sink, None, []
        self.letters: list[str] = []
        self.waiting: list[tuple[int | None, str, str]] = []
        self.place, self.seen, self.state, self.before = 0, set(), _START, None
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, digest: bytes, blank: bool, truncated: bool) -> None:
        if turn is not None:
            if self.first_turn is None:
                self.first_turn = turn
            self.turns += turn != self.last_turn
            self.last_turn = turn
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in ("su", "ua", "au")
        self.before = initial
        letter = initial if initial in ("s", "u", "a") else "x"
        if blank:
            self.blank, letter = self.blank + 1, "d"
        elif digest in self.seen:
            self.duplicate, letter = self.duplicate + 1, "d"
        elif truncated:
            self.truncated, letter = self.truncated + 1, letter.upper()
        self.seen.add(digest)
        self.waiting.append((turn, role, text))
        if self.search:
            self.search.step(letter)
        else:
            self.letters.append(letter)
            if len(self.letters) > SHORT:
                self.search = AuditSearch()
                for letter in self.letters:
                    self.search.step(letter)
        if self.search and len(self.waiting) % SETTLE_EVERY == 0:
            self._apply(self.search.settle())

    def _apply(self, edits: str) -> None:
        self.audit.append(edits)
        at = 0
        for edit in edits:
            turn, role, text = (None, "", "") if edit == "I" else self.waiting[at]
            at += edit != "I"
            if edit in "IR":
                role = "assistant" if self.state == _USER else "user"
            if edit == "D":
                role = None
            else:
                self.state = _KEEPS[role[0]][1]
            self.sink(edit, turn, role, text)
        del self.waiting[:at]

    def close(self) -> dict:
        cost, edits = self.search.finish() if self.search else cheapest_audit("".join(self.letters))
        self._apply(edits)
        return {
            "gaps": 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "cost": cost,
            "audit": "".join(self.audit),
        }


def _in_order(rows: DataFrame, absent: str | None) -> DataFrame:
    """Turns of whole conversations, in order within their partition, with their faults."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    ended = F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text"))
    gone = F.coalesce(F.col(absent), F.lit(False)) if absent else F.lit(False)
    turns = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role, text, gone.alias("gone"))
    digest = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    marked = turns.withColumns({"blank": blank, "truncated": ~ended, "digest": digest})
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


_FIELDS = ("turn", "role", "text", "digest", "blank", "truncated")


def _conversations(batches: Iterator[pa.RecordBatch], make_sink) -> Iterator[tuple[object, Conversation, bool]]:
    """(conversation id, conversation, whether it is complete) at ends of conversations and batches."""
    current, own_id = None, None
    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in _FIELDS]
        ids, gone = batch.column("conv_id").to_pylist(), batch.column("gone").to_pylist()
        for k, conv_id in enumerate(ids):
            if current is None or conv_id != own_id:
                if current is not None:
                    yield own_id, current, True
                own_id, current = conv_id, Conversation(make_sink(conv_id))
            if not gone[k]:
                current.add(*[column[k] for column in columns])
        if current is not None:
            yield own_id, current, False
    if current is not None:
        yield own_id, current, True


class _Digest:
    """sha256 of repaired ``role:text`` lines."""

    def __init__(self):
        self.sum, self.any = hashlib.sha256(), False

    def __call__(self, edit: str, turn: int | None, role: str | None, text: str) -> None:
        if role is not None:
            self.sum.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
            self.any = True


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit_conversations(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """One row per conversation: fault counts, cost, audit, and digest of the repaired text.

    ``rows`` holds conv_id, turn, role and text. Rows whose column ``absent`` is true only name
    their conversation.
    """
    ordered = _in_order(rows, absent)
    kind = ordered.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[dict] = []
        id_type = None

        def batch_of() -> pa.RecordBatch:
            names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
            types = [id_type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], t) for n, t in zip(names, types, strict=True)], names)

        def watched() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in batches:
                id_type = batch.schema.field("conv_id").type
                yield batch

        for conv_id, conversation, complete in _conversations(watched(), lambda _: _Digest()):
            if complete:
                counts = conversation.close()
                found.append({"conv_id": conv_id, **counts, "repaired_sha256": conversation.sink.sum.hexdigest()})
            if len(found) >= 5000:
                yield batch_of()
                found.clear()
        if found:
            yield batch_of()

    counts = ", ".join(f"{name} long" for name in _COUNTS)
    return ordered.mapInArrow(run, f"conv_id {kind}, {counts}, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame, absent: str | None = None) -> DataFrame:
    """Turns after repair: conv_id, place (from 0), edit (K, R or I), turn before, role, text."""
    ordered = _in_order(rows, absent)
    kind = ordered.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "place", "edit", "turn", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def sink_of(conv_id) -> Sink:
            places = iter(range(1 << 62))

            def sink(edit: str, turn: int | None, role: str | None, text: str) -> None:
                if role is not None:
                    out.append((conv_id, next(places), edit, turn, role, text))

            return sink

        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

        def all_batches() -> Iterator[pa.RecordBatch]:
            yield first
            yield from batches

        for _, conversation, complete in _conversations(all_batches(), sink_of):
            if complete:
                conversation.close()
            if len(out) >= 2000 or (out and not complete):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types, strict=True)], names)

    return ordered.mapInArrow(run, f"conv_id {kind}, place long, edit string, turn long, role string, text string")


def damage(rows: DataFrame) -> DataFrame:
    """Rows with planted faults by crc32 of ``conv_id:turn``; dropped rows stay, marked ``gone``."""
    space = F.lit(" ")

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), space)

    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    turns = rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fault.alias("fault"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("fault") == 0).alias("gone"),
        copies.alias("copy"),
    ).drop("copy")

"""Structure repair of conversations with the cheapest edits and their audit trail.

Every row of a conversation is kept, given another role or deleted, and empty rows may be
inserted, until the roles alternate.  A dynamic program over four states (nothing yet, after the
system row, after a user row, after an assistant row) finds the cheapest edits; of equally
cheap ones the audit that is least in ASCII order counts.

Audits are persistent: a node is one row's edits, linked to the node of the rows before, with a
rolling hash of the whole audit and ancestors at powers of two.  So states share their
beginnings, and two audits are compared by a search for the first row in which they
differ; equal hashes are verified by walking the links until both audits share a node.

A conversation is worked on in pieces of PIECE rows: each piece finds its best edits from every
state it may begin in, and the pieces of a conversation are then joined by the same program with
pieces for rows.  Rows travel without their texts until the edits are known.  Then
each conversation's texts pass by once, in order, behind its audit, and are hashed as they pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import stored, with_offsets

#: Rows of a conversation that are edited together.
PIECE = 8192
#: White space of the fault rules (fixed by the contract).
BLANKS = "\t\n\x0b\x0c\r "
#: Costs of the edits and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that may follow in each state, and the state it leads to.
_NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
_AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_NAMES = {"u": b"user", "a": b"assistant"}
#: States in which a conversation may end.
_ENDS = (START, ASSISTANT)
_MOD, _BASE = (1 << 61) - 1, 1_000_003


# ---------------------------------------------------------------- audits

class Audits:
    """Audits as linked nodes; node 0 is the empty audit.

    A node's label holds the edits of one row (or one piece) and ends with the edit that
    uses it up, so equal audits are equal row by row.
    """

    def __init__(self):
        self.parent, self.level, self.label, self.hash = [0], [0], [""], [0]
        self.up: list[list[int]] = [[]]
        self._same: set[tuple[int, int]] = set()

    def add(self, parent: int, label: str) -> int:
        node, h = len(self.parent), self.hash[parent]
        for c in label.encode():
            h = (h * _BASE + c) % _MOD
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.parent.append(parent)
        self.level.append(self.level[parent] + 1)
        self.label.append(label)
        self.hash.append(h)
        self.up.append(up)
        return node

    def _equal(self, a: int, b: int) -> bool:
        """Whether audits of one level and hash are the same text."""
        walked = []
        while a != b and (a, b) not in self._same:
            if self.label[a] != self.label[b]:
                return False
            walked.append((a, b))
            a, b = self.parent[a], self.parent[b]
        self._same.update(walked)
        return True

    def before(self, a: int, label_a: str, b: int, label_b: str) -> bool:
        """Whether audit a with one more label comes before audit b with its label; both have the same level."""
        if a == b or self.hash[a] == self.hash[b] and self._equal(a, b):
            return label_a < label_b
        if self.hash[a] != self.hash[b]:
            # the last ancestors that differ by hash hold the first label that differs
            x, y = a, b
            for k in range(len(self.up[x]) - 1, -1, -1):
                if k < len(self.up[x]):
                    p, q = self.up[x][k], self.up[y][k]
                    if self.hash[p] != self.hash[q]:
                        x, y = p, q
            if self._equal(self.parent[x], self.parent[y]):
                return self.label[x] < self.label[y]
        # different audits share a hash: compare them as texts
        return self.text(a) + label_a < self.text(b) + label_b

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.label[node])
            node = self.parent[node]
        return "".join(reversed(out))


@lru_cache(None)
def _edges(initial: str, removed: bool, truncated: bool) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, label) of every way to deal with a row, inserted rows before it included."""
    out = []
    for state in range(4):
        at = state
        for inserted in range(3):
            cost, label = INSERT * inserted, "I" * inserted
            out.append((state, at, cost + DELETE, label + "D"))
            if not removed:
                late = TRUNCATED * truncated
                if initial == _NEXT[at] or initial == "s" and at == START:
                    out.append((state, _AFTER[initial], cost + late, label + "K"))
                out.append((state, _AFTER[_NEXT[at]], cost + REROLE + late, label + "R"))
            at = _AFTER[_NEXT[at]]
            if at == state:
                break
    return out


def _step(audits: Audits, states: list, edges: list[tuple[int, int, int, str]]) -> list:
    """The best (cost, node) of every state after one more row (or piece); None where none leads there."""
    best: list = [None] * 4
    for before, after, cost, label in edges:
        if states[before] is None:
            continue
        total, node = states[before][0] + cost, states[before][1]
        held = best[after]
        if held is None or total < held[0] or total == held[0] and audits.before(node, label, held[1], held[2]):
            best[after] = (total, node, label)
    return [b and (b[0], audits.add(b[1], b[2])) for b in best]


def piece_edges(rows: list[tuple[str, bool, bool]], starts: range | tuple = range(4)) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit): the best edits of a piece of (initial, removed, truncated) rows."""
    out = []
    for start in starts:
        audits = Audits()
        states: list = [None] * 4
        states[start] = (0, 0)
        for row in rows:
            states = _step(audits, states, _edges(*row))
        out += [(start, state, s[0], audits.text(s[1])) for state, s in enumerate(states) if s]
    return out


def joined(pieces: Iterator[list[tuple[int, int, int, str]]]) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a whole conversation, by its pieces' edges in order."""
    audits = Audits()
    states: list = [(0, 0), None, None, None]
    for edges in pieces:
        states = _step(audits, states, edges)
    ends = [(START, START, 0, ""), (ASSISTANT, ASSISTANT, 0, ""), (USER, ASSISTANT, INSERT, "I"),
            (SYSTEM, ASSISTANT, 2 * INSERT, "II")]
    last = [s for s in _step(audits, states, ends) if s]
    cost = min(s[0] for s in last)
    return cost, min(audits.text(n) for c, n in last if c == cost)


# ---------------------------------------------------------------- rows and faults

def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): every row after damage; n is how often it stands there."""
    conv_id, turn = (F.col(c).cast("long") for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    key = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit(" ")) for c in (conv_id, turn)])
    kind = F.crc32(key) % 20
    return conversations.select(
        conv_id.alias("conv_id"), turn.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _narrow(rows: DataFrame) -> DataFrame:
    """Rows without texts, equal ones together: (conv_id, turn, digest, initial, blank, truncated, n, fresh).

    ``digest`` stands for role and text; ``fresh`` marks rows whose role and text have not
    been seen before in their conversation.
    """
    digest = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    equal = (rows.select("conv_id", "turn", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"),
                         (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"), "n")
             .groupBy("conv_id", "turn", "digest", "initial", "blank", "truncated").agg(F.sum("n").alias("n")))
    equal = stored(equal, "turns")
    # nulls come before all turns; both sides are stored, so a hot conversation's join can be split
    first = stored(equal.where("n > 0").groupBy(F.col("conv_id").alias("f_id"), F.col("digest").alias("f_digest"))
                   .agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn")).alias("first")), "first-turns")
    both = equal.join(first, _same("conv_id", "f_id") & (F.col("digest") == F.col("f_digest")), "left")
    fresh = F.col("first.turn").eqNullSafe(F.col("turn")) & (F.col("n") > 0)
    return both.select(*equal.columns, F.coalesce(fresh, F.lit(False)).alias("fresh"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal")
_PIECES = ("conv_id long, piece long, " + ", ".join(f"{c} long" for c in _COUNTS)
           + ", first string, last string, least long, most long, turns long, edges array<struct<a:int,b:int,cost:long,audit:string>>")


def _by_piece(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per piece of a conversation: its counts and its edges; rows come sorted by conversation and place."""
    def closed(key: tuple, rows: list[tuple]) -> dict:
        counts, moves, initials, turns = dict.fromkeys(_COUNTS, 0), [], [], []
        for turn, initial, blank, truncated, n, fresh in rows:
            once = fresh and not blank
            counts["blank"] += n * blank
            counts["duplicate"] += 0 if blank else n - once
            counts["truncated"] += once and truncated
            moves += [(initial, False, truncated)] * once + [(initial, True, False)] * (n - once)
            initials += [initial] * n
            if n and turn is not None and turns[-1:] != [turn]:
                turns.append(turn)
        counts["illegal"] = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        edges = piece_edges(moves, (START,) if key[1] == 0 else range(4))
        return {"conv_id": key[0], "piece": key[1], **counts, "first": initials[0] if initials else None,
                "last": initials[-1] if initials else None, "least": min(turns, default=None),
                "most": max(turns, default=None), "turns": len(turns),
                "edges": [dict(zip(("a", "b", "cost", "audit"), e)) for e in edges]}

    key, held, out, edits = None, [], [], 0
    for b in batches:
        for conv_id, piece, *row in zip(*(c.to_pylist() for c in b.columns)):
            if key != (conv_id, piece):
                if held:
                    out.append(closed(key, held))
                    edits += len(held)
                    if edits > PIECE:
                        yield pa.RecordBatch.from_pylist(out, schema=_arrow())
                        out, edits = [], 0
                key, held = (conv_id, piece), []
            held.append(tuple(row))
    if held:
        out.append(closed(key, held))
    yield pa.RecordBatch.from_pylist(out, schema=_arrow())


def _arrow() -> pa.Schema:
    edge = pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    text = {"first", "last"}
    names = ["conv_id", "piece", *_COUNTS, "first", "last", "least", "most", "turns"]
    return pa.schema([(n, pa.string() if n in text else pa.int64()) for n in names] + [("edges", pa.list_(edge))])


_SUMMARY = "conv_id long, gaps long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", cost long, audit string"


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its pieces, which come in order."""
    names = [c.split()[0] for c in _SUMMARY.split(", ")]

    def closed(pieces: list[dict]) -> dict:
        out = {"conv_id": pieces[0]["conv_id"], **{c: sum(p[c] for p in pieces) for c in _COUNTS}}
        full = [p for p in pieces if p["first"] is not None]
        out["illegal"] += sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(full, full[1:]))
        dated = [p for p in pieces if p["turns"]]
        different = sum(p["turns"] for p in dated) - sum(a["most"] == b["least"] for a, b in zip(dated, dated[1:]))
        out["gaps"] = dated[-1]["most"] - dated[0]["least"] + 1 - different if dated else 0
        out["cost"], out["audit"] = joined([tuple(e.values()) for e in p["edges"]] for p in pieces)
        return out

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.string() if c == "audit" else pa.int64())
                                           for c in names], names)

    held: list[dict] = []
    for b in batches:
        out = []
        for row in b.to_pylist():
            if held and held[-1]["conv_id"] != row["conv_id"]:
                out.append(closed(held))
                held = []
            held.append(row)
        yield batch(out)
    if held:
        yield batch([closed(held)])


# ---------------------------------------------------------------- repaired texts

class _Repair:
    """Replays an audit over a conversation's rows and hashes what it makes of them."""

    def __init__(self, audit: str):
        self._edits, self._state = iter(audit), START
        self._hash, self._some = hashlib.sha256(), False

    def _line(self, initial: str, role: bytes, text: bytes) -> None:
        self._hash.update(b"\n" * self._some + role + b":" + text)
        self._some, self._state = True, _AFTER[initial]

    def _insert(self) -> None:
        role = _NEXT[self._state]
        self._line(role, _NAMES[role], b"")

    def row(self, role: str, text: str) -> None:
        for edit in self._edits:
            if edit == "I":
                self._insert()
                continue
            if edit == "K":
                self._line(role[0], role.encode(), text.encode())
            elif edit == "R":
                new = _NEXT[self._state]
                self._line(new, _NAMES[new], text.encode())
            return

    def digest(self) -> str:
        for _ in self._edits:
            self._insert()
        return self._hash.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summary rows with the hash of the texts that follow each of them; no text is held."""
    names = [*(c.split()[0] for c in _SUMMARY.split(", ")), "repaired_sha256"]
    summary = repair = None

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64() if c not in text else pa.string())
                                           for c in names], names)

    text = ("audit", "repaired_sha256")
    for b in batches:
        out = []
        for at in range(0, b.num_rows, 64):  # texts may be long: few are Python objects at a time
            for row in b.slice(at, 64).to_pylist():
                if row["summary"] is not None:
                    if summary is not None:
                        out.append({**summary, "repaired_sha256": repair.digest()})
                    summary, repair = {**row["summary"], "conv_id": row["conv_id"]}, _Repair(row["summary"]["audit"])
                else:
                    for _ in range(row["n"]):
                        repair.row(row["role"], row["text"])
        yield batch(out)
    if summary is not None:
        yield batch([{**summary, "repaired_sha256": repair.digest()}])


def repair(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are damaged by the crc32 of their ``conv_id:turn``, then taken by turn (nulls first; rows of
    one turn by the MD5 of their role and text, equal ones next to each other).  Null roles and texts
    are one space, and so is a null id or turn within the crc32; rows with a null conv_id are one
    conversation.  A conversation that loses all rows has zeros, an empty audit and the hash
    of the empty text.  Other columns are ignored.

    A conversation of any length is edited in pieces by many tasks.  Its audit, a letter per
    edit, is one value of the result, and SHA-256 takes a text from front to back: so one
    task joins a conversation's pieces, and its texts pass through one task, which holds a few at a time.
    """
    rows = damaged(conversations)
    placed = with_offsets(stored(_narrow(rows), "turn-rows"), "conv_id", ["turn", "digest"], "n", "pos")
    pieces = (placed.select("conv_id", F.floor(F.col("pos") / piece).alias("piece"), "turn", "initial", "blank", "truncated",
                            "n", "fresh", "pos", "digest")
              .repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos", "turn", "digest")
              .drop("pos", "digest").mapInArrow(_by_piece, _PIECES))
    summaries = stored(stored(pieces, "pieces").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
                       .mapInArrow(_by_conversation, _SUMMARY), "audits")
    head = summaries.select("conv_id", F.struct(*[c for c in summaries.columns if c != "conv_id"]).alias("summary"),
                            F.lit(0).alias("part"))
    body = rows.where("n > 0").withColumn("part", F.lit(1)).withColumn("digest", F.md5(F.concat(
        F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))))
    return (head.unionByName(body, allowMissingColumns=True).repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "turn", "digest").select("conv_id", "summary", "role", "text", "n")
            .mapInArrow(_hashed, _SUMMARY + ", repaired_sha256 string"))

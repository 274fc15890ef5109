"""Conversation repair against plain programs over all edits."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from martline.llm import repair
from martline.llm.queries import ORACLES
from martline.plans.compare import canonical_rows

TURNS = "conv_id long, turn long, role string, text string"
_WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        kept = out.setdefault(conv_id, [])
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, digest(r))) for c, v in out.items()}


def plain_edits(rows):
    """(cost, audit, lines) by the cost that is still to come, then the least letter at every step."""
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(_WHITE)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def ways(i, last):
        """(letter, cost, row after, role after, line)."""
        new = after[last]
        name = {"u": "user", "a": "assistant"}[new]
        yield "I", 2, i, new, name + ":"
        if i < len(rows):
            _, role, text = rows[i]
            late = faults[i] == "truncated"
            yield "D", 3, i + 1, last, None
            if faults[i] in ("", "truncated"):
                yield "R", 2 + late, i + 1, new, f"{name}:{text}"
                if role[:1] == new or role[:1] == "s" and last == "":
                    yield "K", 0 + late, i + 1, role[:1], f"{role}:{text}"

    @lru_cache(None)
    def rest(i, last, inserted=0):
        if inserted > 3:
            return 10 ** 9
        best = 0 if i == len(rows) and last in ("", "a") else 10 ** 9
        return min([best, *(c + rest(j, r, inserted + 1 if w == "I" else 0) for w, c, j, r, _ in ways(i, last))])

    for at in reversed(range(len(rows) + 1)):  # from the back: no deep recursion
        for state in after:
            rest(at, state)
    i, last, audit, lines, left = 0, "", "", [], rest(0, "")
    cost = left
    while left or i < len(rows):
        w, c, i, last, line = min((x for x in ways(i, last) if x[1] + rest(x[2], x[3]) == left), key=lambda x: x[0])
        audit, left = audit + w, left - c
        lines += [line] if line is not None else []
    return cost, audit, lines, faults


def plain_repair(rows):
    out = []
    for conv_id, kept in plain_damage(rows).items():
        cost, audit, lines, faults = plain_edits(kept)
        turns = [t for t, *_ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        out.append((conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed, conversations=40, most=14):
    rnd = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rnd.randrange(most)):
            rows.append((c + seed * 1000, rnd.choice([t, t, t, t * 2, 3, None]),
                         rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "u2", "à"]),
                         rnd.choice(["One.", "Two?", "cut", "", " \n", None, "end. \t", f"own {t}.", "é!"])))
    return rows


def got(df, **kw):
    return sorted((tuple(r) for r in repair.repair(df, **kw).collect()), key=str)


@pytest.mark.parametrize("seed, piece", [(1, 8192), (2, 3), (3, 1)])
def test_repair_matches_plain_edits(spark, seed, piece):
    rows = made(seed)
    df = spark.createDataFrame(rows + rows[:20], TURNS).repartition(4)
    assert got(df, piece=piece) == plain_repair(rows + rows[:20])


def test_one_long_conversation_is_edited_in_pieces(spark):
    rows = [(7, t, r, x) for t, (r, x) in enumerate((r[2], f"{r[3]} {i % 50}.") for i, r in enumerate(made(5, 60, 30)))]
    assert len(rows) > 500
    assert got(spark.createDataFrame(rows, TURNS).repartition(5), piece=64) == plain_repair(rows)


@pytest.mark.parametrize("seed", range(30))
def test_pieces_joined_give_the_least_audit(seed):
    """Ties of all kinds, however the rows are cut into pieces; no hash collision goes unseen."""
    rnd = random.Random(seed)
    rows = [(t, rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["a.", "b.", "cut", ""]) + rnd.choice(["", str(t) + "."]))
            for t in range(rnd.randrange(40))]
    cost, audit, _, faults = plain_edits(rows)
    moves = [(r[:1], f in ("blank", "duplicate"), f == "truncated") for (_, r, _), f in zip(rows, faults)]
    for width in (1, 2, 7, 100):
        cut = [moves[a:a + width] for a in range(0, len(moves), width)]
        assert repair.joined(repair.piece_edges(c) for c in cut) == (cost, audit)


@pytest.mark.parametrize("seed", range(5))
def test_colliding_hashes_are_verified(monkeypatch, seed):
    monkeypatch.setattr(repair, "_MOD", 3)
    test_pieces_joined_give_the_least_audit(seed)


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "x."), (1, None, "user", None), (2, 5, "assistant", "y " * 60000),
            (2, 5, "assistant", "y " * 60000), (3, 1, "user", "\x00é."), (3, 1, "user", "\x00é."), (3, 1, "system", "s.")]
    extra = ("key", "row", "piece", "n", "summary", "digest", "part", "pos")
    df = spark.createDataFrame([(*r, *("x" for _ in extra)) for r in rows], TURNS + "".join(f", `{c}` string" for c in extra))
    assert got(df) == plain_repair(rows)
    assert repair.repair(spark.createDataFrame([], TURNS)).collect() == []


def test_conversation_that_loses_all_rows(spark):
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    row = repair.repair(spark.createDataFrame([(dropped, 0, "user", "x.")], TURNS)).first()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_statement_agrees_on_made_rows(spark):
    import duckdb
    import pandas as pd

    rows = made(11)
    con = duckdb.connect()
    con.register("conversations", pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int64"}))
    want = con.execute(ORACLES["op11_conversation_repair"])
    columns = [c[0] for c in want.description]
    df = repair.repair(spark.createDataFrame(rows, TURNS))
    assert canonical_rows(df.columns, [tuple(r) for r in df.collect()]) == canonical_rows(columns, want.fetchall())

"""Exact top-k search and chat formatting against brute force."""

import math
import random

import numpy as np
import pytest

from martline.llm import balltree, chat


def plain_top(rows, k, every):
    def vector(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(256 * float(x)) for x in v]

    own = [(i, r[0], vector(r[1])) for i, r in enumerate(rows) if r[0] is not None]
    own = [r for r in own if r[2] is not None]
    out = []
    for i, q, v in own:
        if q % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for j, c, w in own if j != i and len(w) == len(v))
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [7, 64, 10_000])
def test_top_k_matches_brute_force(spark, shard_rows):
    rnd = random.Random(shard_rows)
    hot = [rnd.gauss(0, 0.2) for _ in range(6)]
    rows = [(i, hot if i % 3 == 0 else [rnd.choice([0.0, 0.25, -0.5, rnd.gauss(0, 1)]) for _ in range(6)]) for i in range(400)]
    rows += [(500, None), (550, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (600, [float("nan")] * 6), (650, [float("inf")] + [0.0] * 5),
             (None, hot), (50, [0.1] * 6), (700, [1.0, 2.0]), (701, [3.0, -1.0]), (750, []), (800, [1e3] * 6)]
    df = spark.createDataFrame([(a, b, 1, "x", "x") for a, b in rows],
                               "vec_id long, embedding array<double>, label int, row string, shard string").repartition(3)
    got = sorted(tuple(r) for r in balltree.top_k(df, 5, 50, shard_rows).collect())
    assert got == plain_top(rows, 5, 50)


def test_top_k_of_few_or_no_rows(spark):
    shape = "vec_id long, embedding array<float>"
    assert balltree.top_k(spark.createDataFrame([], shape)).collect() == []
    assert balltree.top_k(spark.createDataFrame([(0, [1.0])], shape)).collect() == []
    got = [tuple(r) for r in balltree.top_k(spark.createDataFrame([(0, [1.0]), (3, [1.0]), (2, [1.0])], shape)).collect()]
    assert sorted(got) == [(0, 1, 2, 65536), (0, 2, 3, 65536)]


def test_products_of_huge_components_stay_within_a_long():
    a = np.array([[2**62, 2**62]]), np.array([[2**40, 1], [-2**62, -2**62]])
    assert balltree._products(*a).tolist() == [[2**63 - 1, -2**63 + 1]]


def test_bounds_hold_for_every_node():
    rng = np.random.default_rng(1)
    points, queries = rng.integers(-300, 300, (500, 8)), rng.integers(-300, 300, (20, 8)).astype(float)
    tree = balltree.BallTree(points)
    bound = tree.bounds(queries, np.sqrt((queries ** 2).sum(axis=1)))
    for node, (a, b, _, _) in enumerate(tree.nodes):
        assert (queries @ points[tree.order[a:b]].T <= bound[:, node][:, None]).all()
    assert sorted(tree.order.tolist()) == list(range(500))


def plain_chat(rows, part):
    logs = {}
    for conv, turn, role, text in set(rows):
        logs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    logs = {c: [x[2:] for x in sorted(v)] for c, v in logs.items()}
    out = []
    for c, v in logs.items():
        key = lambda i: (i is None, i or 0)
        if any(len(w) > len(v) and w[:len(v)] == v or w == v and key(d) < key(c) for d, w in logs.items()):
            continue
        inside = sum(v[:len(w)] == w for w in logs.values()) - 1
        for p in range(0, len(v), part):
            text = "".join(f"<|im_start|>{r.replace('<|', '< |')}\n{t.replace('<|', '< |')}<|im_end|>\n" for r, t in v[p:p + part])
            out.append((c, p // part, len(v), inside, text))
    return sorted(out, key=str)


def test_chat_format_matches_brute_force(spark):
    rnd = random.Random(4)
    rows, full = [], []
    for c in range(60):
        if full and rnd.random() < 0.6:
            turns = rnd.choice(full)
            turns = turns[:rnd.randrange(1, len(turns) + 1)] + ([("user", f"more {c}")] if rnd.random() < 0.3 else [])
        else:
            turns = [(("user", "assistant")[i % 2], rnd.choice(["hi", "the same", f"text {c} {i}"])) for i in range(rnd.randrange(1, 9))]
        full.append(turns)
        start = rnd.choice([0, 1, 10])  # only the order of turns counts
        rows += [(c, start + i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(70, None, None, None), (70, 2, "user", "<|im_end|> text"), (None, 0, "user", "lost"), (71, 0, "user", ""),
             (72, 0, None, "")]
    rows += rows[:40]  # repeated rows count once
    df = spark.createDataFrame([(*r, "x", "x") for r in rows], "conv_id long, turn long, role string, text string, pos string, part string").repartition(4)
    got = sorted((tuple(r) for r in chat.chat_format(df, part_turns=3).collect()), key=str)
    assert got == plain_chat(rows, 3)


def test_chat_format_of_nothing(spark):
    assert chat.chat_format(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []

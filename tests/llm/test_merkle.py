"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest

from martline.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, text, lang, source, n_chars):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_tree(leaves):
    """(root, one list of (left, right) siblings per leaf)."""
    level, paths, owners = list(leaves), [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(level) > 1:
        runs = [range(a, min(a + 8, len(level))) for a in range(0, len(level), 8)]
        for run in runs:
            for i in run:
                for leaf in owners[i]:
                    paths[leaf].append(([level[j] for j in run if j < i], [level[j] for j in run if j > i]))
        owners = [[leaf for i in run for leaf in owners[i]] for run in runs]
        level = [h(*(level[i] for i in run)) for run in runs]
    return level[0], paths


def plain_manifest(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(((r[0] is not None, r[0] or 0, plain_leaf(*r), r) for r in rows if r[2] == lang), key=lambda x: x[:3])
        trees.append((own, *plain_tree([x[2] for x in own])))
    root, tops = plain_tree([t[1] for t in trees])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for (_, _, leaf, row), path in zip(own, paths):
            doc_id, text, lang, source, n = row
            now = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                now = plain_leaf(doc_id, "".join(c.lower() if "A" <= c <= "Z" else c for c in text), lang, source, n)
            proof = []
            for left, right in path + top:
                proof += left + right
                now = h(*left, now, *right)
            out.append((doc_id, leaf, subroot, root, h(*proof), now, now == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in merkle.verify(df).collect()), key=str)


@pytest.mark.parametrize("block", [4096, 2])
def test_manifest_matches_a_plain_tree(spark, docs_of, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rnd = random.Random(block)
    sizes = {"en": 150, None: 9, "de": 1, "é": 8, "fr": 65, "": 3, "z": 64, "a": 1, "b": 1, "c": 2, "ö": 1}
    rows, i = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            i += 1
            rows.append((i, rnd.choice(["Text A", "lower", "É only", "", None]), lang, rnd.choice(["s", None]), rnd.choice([5, None])))
    want = plain_manifest(rows)
    assert got(docs_of(rows)) == want
    assert {w[6] for w in want} == {True, False}


def test_awkward_and_few_rows(awkward, no_docs, docs_of):
    rows = [tuple(r)[:5] for r in awkward.collect()]
    assert got(awkward) == plain_manifest(rows)
    assert merkle.verify(no_docs).collect() == []
    for n in (1, 2, 8, 9):
        few = [(i, f"Text {i}", "en", "s", 6) for i in range(n)]
        assert got(docs_of(few)) == plain_manifest(few)
    only = merkle.verify(docs_of([(2, "x", None, None, None)])).collect()
    assert only[0].proof_sha256 == h() and only[0].leaf == only[0].root == only[0].subroot and only[0].verified


def test_row_limit_of_recursion_is_restored(spark, docs_of):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.verify(docs_of([(1, "a"), (2, "b")])).collect()
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before

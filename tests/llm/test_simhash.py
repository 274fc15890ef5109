"""SimHash near-dedup against brute force."""

import random
from collections import defaultdict

import numpy as np
import xxhash

from martline.llm import simhash
from martline.llm.components import roots


def plain_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def near_texts(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        if out and rnd.random() < 0.6:
            words = rnd.choice(out).split()
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                words[rnd.randrange(len(words))] = f"new{rnd.randrange(99)}"
            out.append(" ".join(words))
        else:
            out.append(" ".join(f"w{rnd.randrange(400)}" for _ in range(rnd.choice([3, 9, 60, 160]))))
    return out


def test_near_duplicates_match_brute_force(docs_of):
    texts = near_texts(250, 1) + ["", None, "One", "ONE", "one  one", "ÉTÉ été"]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(list(enumerate(texts)))).collect()}
    fps = [plain_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{f:016x}" for f in fps]
    close = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    want = plain_components(range(len(fps)), close)
    assert {i: got[i]["component_id"] for i in got} == want
    assert len(set(want.values())) < len(texts) - 60


def test_awkward_rows(awkward, no_docs):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == awkward.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(zero) == 4 and {r["component_id"] for r in zero} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] == 7} == {5}
    assert simhash.near_duplicates(no_docs).collect() == []


def test_keep_one_leaves_one_row_of_each_component(awkward, no_docs):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["key"]) for r in rows if r["text"] == "twice the same row") == [(False, 5, "x")]
    assert len([r for r in rows if not (r["text"] or "").split()]) == 1
    assert simhash.keep_one(no_docs).collect() == []


def test_probing_finds_every_pair_with_crowded_parts_and_split_buckets(monkeypatch):
    """Fingerprints that share part values: thresholds move away from crowded parts, and no pair is lost."""
    monkeypatch.setattr(simhash, "BLOCK", 2)
    rnd = np.random.default_rng(5)
    base = rnd.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = {int(b) & ~0xFFFF for b in base} | {int(b) for b in base[:10]}
    for f in list(fps):
        for _ in range(6):
            for bit in rnd.choice(63, rnd.integers(1, 6), replace=False):
                f ^= 1 << int(bit)
            fps.add(f)
    fps = np.array(sorted(fps), np.int64)
    runs = 0
    for m in (2, 3, 4):
        both = (lambda x: (x.T @ x).astype(np.int64))(simhash._bit_matrix(fps).astype(float))
        parts = simhash.group_bits(len(fps), both, m)
        assert sorted(np.concatenate(parts).tolist()) == list(range(64))
        units = simhash._units(parts)
        hists = [[np.bincount(simhash._value(simhash._bit_matrix(fps), u), minlength=1 << len(u)) for u in us] for us in units]
        layout = simhash.Layout(len(fps), 4, parts, hists)
        assert (layout.thresholds(simhash._bit_matrix(fps)) + 1).sum(axis=0).tolist() == [5] * len(fps)
        buckets = defaultdict(lambda: ([], []))
        for bucket, run, fp, probe in simhash._probe_rows(layout, fps):
            runs = max(runs, int(run.max(initial=0)))
            for b, r, f in zip(bucket.tolist(), run.tolist(), fp.tolist()):
                buckets[b, r][probe].append(f)
        found = {(x, y) for data, probes in buckets.values() for x in data for y in probes
                 if x < y and ((x ^ y) & (1 << 64) - 1).bit_count() <= 4}
        want = {(int(x), int(y)) for i, y in enumerate(fps) for x in fps[:i] if ((int(x) ^ int(y)) & (1 << 64) - 1).bit_count() <= 4}
        assert found == want and want
    assert runs > 0


def test_part_count_grows_coarser_with_the_corpus():
    assert simhash.part_count(1000, 4) >= simhash.part_count(10**6, 4) >= simhash.part_count(10**10, 4) == 2


def test_components_of_random_graphs_a_chain_and_a_hub(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 2000 + i) for i in range(400)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in roots(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = plain_components(nodes, links[:-1])
    assert {n: got.get(n, n) for n in nodes} == want
    assert roots(spark.createDataFrame([], "u long, v long")).collect() == []

"""Mixing to target weights and token counts against brute force."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from martline.llm import mixing, tokens
from martline.llm.common import with_offsets

TOKENIZERS = ["piece_bpe_32k.model", "byte_bpe_50k.json"]


def plain_targets(sizes, weights, most=3):
    """The same shares, found by handing out the excess again and again."""
    total, capped = Fraction(sum(sizes)), set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        share = [Fraction(most * s) if i in capped else left * w / free for i, (s, w) in enumerate(zip(sizes, weights))]
        above = {i for i, s in enumerate(share) if s > most * sizes[i]}
        if not above:
            return share
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 1000, 5, 0, 3], [0, 0], [7], [3, 3000]])
def test_targets_share_all_words_and_stop_at_three_times_a_size(sizes):
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))]
    got = mixing.targets(sizes, weights)
    assert got == plain_targets(sizes, weights) and sum(got) == sum(sizes)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations_are_permutations(n):
    out = mixing.permuted(np.arange(n), n, 99)
    assert sorted(out.tolist()) == list(range(n))
    assert mixing.permuted(out, n, 99, back=True).tolist() == list(range(n))
    if n > 60:
        assert (out != np.arange(n)).mean() > 0.9 and out.tolist() != mixing.permuted(np.arange(n), n, 100).tolist()


def source_docs(docs_of):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(300):
        source = [None, "b", "a", "é", "zz"][int(rng.choice(5, p=[0.05, 0.05, 0.7, 0.1, 0.1]))]
        rows.append((i, "w " * int(rng.choice([0, 1, 7, 200, 900])), "en", source, 0))
    return rows + [(0, "w " * 40, "en", "tiny", 0), (0, "w " * 40, "en", "tiny", 0), (301, None, None, "empty", None)]


@pytest.mark.parametrize("block, shard", [(16, 64), (128, 16_384), (1, 50)])
def test_sources_end_on_their_targets(docs_of, block, shard):
    rows = source_docs(docs_of)
    got = mixing.mix_sources(docs_of(rows), block_words=block, shard_slots=shard).collect()
    names = sorted({r[3] for r in rows} - {None}) + [None]
    sizes = [sum(len((r[1] or "").split()) for r in rows if r[3] == n) for n in names]
    target = dict(zip(names, plain_targets(sizes, [mixing.WEIGHTS[i % 3] for i in range(len(names))])))
    assert sorted((r["doc_id"], r["size"], r["source"] or "") for r in got) == \
        sorted((r[0], len((r[1] or "").split()), r[3] or "") for r in rows)
    for n, size in zip(names, sizes):
        own = [r for r in got if r["source"] == n]
        assert {r["source_size"] for r in own} == {size} and {r["target"] for r in own} == {float(target[n])}
        assert sum(r["taken"] for r in own) == round(target[n])
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)


def test_reruns_agree_however_the_rows_are_dealt(docs_of):
    rows = source_docs(docs_of)
    a, b = (sorted(map(tuple, mixing.mix_sources(docs_of(rows, n), block_words=16, shard_slots=64).collect()), key=str)
            for n in (1, 5))
    assert a == b


def test_slots_hold_whole_blocks_in_shards_of_mixed_sources(docs_of):
    documents, mix = mixing.mixed(docs_of(source_docs(docs_of)), block_words=16, shard_slots=64)
    mix = mix.join(documents.select("row", "source", "size"), "row").collect()
    slots = {}
    for r in mix:
        assert 0 <= r["at"] and r["at"] + r["n_words"] <= r["size"]
        slots.setdefault((r["shard"], r["place"]), []).append(r)
    assert all(sum(r["n_words"] for r in s) <= 16 and len({r["source"] for r in s}) == 1 for s in slots.values())
    assert sum(sum(r["n_words"] for r in s) == 16 for s in slots.values()) > 0.95 * len(slots)
    by_shard = {}
    for (shard, _), s in slots.items():
        by_shard.setdefault(shard, []).append(s[0]["source"])
    assert max(map(len, by_shard.values())) <= 64
    assert all(len(set(v)) > 2 for v in by_shard.values() if len(v) > 60)


def test_mixing_awkward_rows(awkward, no_docs):
    rows = mixing.mix_sources(awkward).collect()
    assert len(rows) == awkward.count()
    assert mixing.mix_sources(no_docs).collect() == []


def test_running_offsets_of_a_hot_key(spark):
    rows = [(0 if i % 3 else None, i, i % 7) for i in range(500)] + [(5, 0, 1)]
    got = with_offsets(spark.createDataFrame(rows, "k long, o long, n long").repartition(5), "k", ["o"], "n", "begin").collect()
    seen = {}
    for k, o, n in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        assert next(r["begin"] for r in got if (r["k"], r["o"]) == (k, o)) == seen.get(k, 0)
        seen[k] = seen.get(k, 0) + n
    assert len(got) == len(rows)


# ---------------------------------------------------------------- token counts

@pytest.mark.parametrize("name", TOKENIZERS)
def test_counts_are_the_librarys(docs_of, awkward, no_docs, name):
    from tokenizers import Tokenizer
    import sentencepiece

    path = tokens.tokenizer_path(name)
    if name.endswith(".model"):
        known = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(known.encode(t))
    else:
        count = lambda t: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids)
    texts = ["", None, " ", "Hello  world\n", "<s> special </s> <unk> <|endoftext|>", "日本語 é́ \U0001F600", "word " * 5000]
    rows = {r["doc_id"]: r for r in tokens.token_counts(docs_of(list(enumerate(texts))), name).collect()}
    for i, t in enumerate(texts):
        assert (rows[i]["n_tokens"], rows[i]["n_bytes"]) == (count(t or ""), len((t or "").encode()))
        assert rows[i]["over_limit"] == (rows[i]["n_tokens"] > 4096)
    assert len(tokens.token_counts(awkward, name).collect()) == awkward.count()
    assert tokens.token_counts(no_docs, name).collect() == []


def test_only_distinct_misses_are_encoded_and_stored(spark, docs_of, scratch):
    cache = scratch + "/cache"
    first = docs_of([(1, "one text"), (2, "one text"), (3, "another text"), (4, None), (5, "")])
    tokens.token_counts(first, cache=cache).collect()
    assert spark.read.parquet(cache).count() == 3
    # a stored count is used as it is: the text is not encoded again
    spark.read.parquet(cache).withColumn("n_tokens", F.lit(777).cast("long")).write.parquet(scratch + "/changed")
    second = docs_of([(1, "one text"), (6, "a new text")])
    rows = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(second, cache=scratch + "/changed").collect()}
    assert rows[1] == 777 and rows[6] != 777
    assert spark.read.parquet(scratch + "/changed").count() == 4
    other = tokens.token_counts(second, tokenizer="byte_bpe_50k.json", cache=scratch + "/changed").collect()
    assert 777 not in {r["n_tokens"] for r in other}  # another tokenizer's counts are its own

"""Packing against a plain reassembly of every document and sequence."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martline.llm import packing
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def library():
    known = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: [*known.encode(text or "", add_special_tokens=False).ids, 1]


def held(rows, texts, library, size):
    """Every token of every document in one piece, every sequence gapless; returns the sequences' lengths."""
    ids, pieces, sequences = Counter(), Counter(), {}
    for t in texts:
        ids[tuple(t)] += 1
    by_doc = {}
    for r in rows:
        by_doc.setdefault(tuple(r[:1]), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    lengths = []
    for laid in sequences.values():
        at = 0
        for offset, length in sorted(laid):
            assert offset == at and length > 0
            at += length
        assert at <= size
        lengths.append(at)
    return by_doc, lengths


def plain_check(rows, docs, library, size):
    by_doc, lengths = held(rows, [], library, size)
    for (doc_id,), pieces in by_doc.items():
        want = Counter()
        for i, text in docs:
            if i == doc_id:
                ids = library(text)
                want[len(ids)] += len(ids)
        # pieces of documents that share an id: cover by length
        got = Counter()
        for p in pieces:
            got[p.doc_tokens] += p.length
        assert got == want
    for doc_id, text in docs:
        ids = np.array(library(text), "<u4")
        if sum(i == doc_id for i, _ in docs) > 1:
            continue
        at = 0
        for p in sorted(by_doc[(doc_id,)], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    assert all(n == size or n & (n - 1) == 0 for n in lengths)
    assert sum(n != size for n in lengths) <= size.bit_length()
    return lengths


@pytest.mark.parametrize("size", [16, 64, 2048])
def test_pieces_give_back_every_document(spark, docs_of, library, size):
    rnd = random.Random(size)
    docs = [(i, " ".join(rnd.choice(["a", "bc", "Über", "12", "x\ny", "<|endoftext|>"]) for _ in range(rnd.randrange(60))))
            for i in range(120)] + [(200, None), (201, ""), (202, "word " * 900)]
    rows = packing.pack_documents(docs_of(docs), size=size).collect()
    lengths = plain_check(rows, docs, library, size)
    assert sum(lengths) == sum(len(library(t)) for _, t in docs)


def test_query_on_the_whole_table(spark, library):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    from martline.llm.queries import op13_packing

    rows = op13_packing(spark, SMALL).collect()
    assert plain_check(rows, docs, library, 2048).count(2048) == sum(len(library(t)) for _, t in docs) // 2048


def test_awkward_rows(spark, awkward, no_docs, library):
    rows = packing.pack_documents(awkward).collect()
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    plain_check(rows, docs, library, 2048)
    again = packing.pack_documents(awkward.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert packing.pack_documents(no_docs).collect() == []


@pytest.mark.parametrize("seed", range(8))
def test_patterns_hold_the_histogram_in_longest_first_order(seed):
    rnd = random.Random(seed)
    histogram = {rnd.randrange(1, 64): rnd.randrange(1, 10 ** rnd.randrange(1, 12)) for _ in range(rnd.randrange(1, 40))}
    got = Counter()
    for pattern, tokens, n in packing.shortest_pack_first(histogram, 64):
        lengths = [length for length, _ in pattern]
        assert lengths == sorted(set(lengths), reverse=True) and tokens == sum(a * b for a, b in pattern) <= 64
        for length, each in pattern:
            got[length] += each * n
    assert got == histogram
    found = packing.plan(histogram, 64)
    total = sum(a * b for a, b in histogram.items())
    assert found.sequences == total // 64 + (total % 64).bit_count()


def test_shortest_pack_first_places_one_by_one_like_the_counts():
    """The grouped placement opens as many packs as placing every length for itself."""
    rnd = random.Random(4)
    for _ in range(50):
        lengths = sorted((rnd.randrange(1, 32) for _ in range(rnd.randrange(1, 60))), reverse=True)
        rooms = []
        for length in lengths:
            best = max(range(len(rooms)), key=rooms.__getitem__, default=None)
            if best is None or rooms[best] < length:
                rooms.append(32 - length)
            else:
                rooms[best] -= length
        got = packing.shortest_pack_first(Counter(lengths), 32)
        assert sum(n for *_, n in got) == len(rooms)
        assert sum(tokens * n for _, tokens, n in got) == sum(lengths)


def test_words_are_encoded_as_in_the_whole_text(library):
    rnd = random.Random(9)
    known = packing.Encoder("byte_bpe_50k.json")
    parts = [" ", " ", "  ", "\n", "\t", " \n", "a", "b", "'s", "'", "12", ".", "é", "᠎", "​", "﻿",
             "<|endoftext|>", "日", "\x1c", "\x85", "😀", "_", " "]
    for _ in range(4000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        assert np.frombuffer(known.ids([text.encode()])[0], "<u4").tolist() == library(text)[:-1]


def test_words_are_learned_in_parts_as_the_library_has_them(library, monkeypatch):
    rng = random.Random(5)
    parts = ["and", "Tree", "\u00fcber", "\u0142\u00f3d\u017a", "na\u00efve", "don't", "x's", "\u00aa", "\u00d7", "e\u0301t", "12", "a1",
             "\u0416\u0436", "\u4e2d\u6587", "<|endoftext|>", "word<|endoftext|>", "(", "\"", "-"]
    ends = ["", "", "", ",", ".", "!?", "...", ";:", "'s", ".'s", "\u2026"]
    gaps = [" ", " ", " ", " ", "\n", "\n\n", ".\n", "  ", "\r\n", "\t"]
    texts = ["".join(rng.choice(parts) + rng.choice(ends) + rng.choice(gaps) for _ in range(rng.randrange(40))) for _ in range(400)]
    for room in (packing.WORDS, 50):
        monkeypatch.setattr(packing, "WORDS", room)
        got = packing.Encoder("byte_bpe_50k.json").ids([t.encode() for t in texts])
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [library(t)[:-1] for t in texts]


def test_a_word_with_punctuation_is_encoded_once():
    words = packing.Encoder("byte_bpe_50k.json")._words
    calls = []
    words.encode = lambda text, encode=words.encode: calls.append(text) or encode(text)
    assert all(words[w] for w in ("tree", "tree,", "tree.", "trees\ntree", "trees,"))
    assert calls == []      # letters go to the merges, marks are kept

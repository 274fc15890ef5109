"""Removal of long repeats against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from martline.llm import runindex


def plain_marks(texts, length):
    texts = [(t or "").encode() for t in texts]
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    marks = []
    for t in texts:
        m = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                m[i:i + length] = b"\1" * length
        marks.append(m)
    return texts, marks


def plain_report(texts, length):
    out = []
    for t, m in zip(*plain_marks(texts, length)):
        kept = bytes(b for b, x in zip(t, m) if not x)
        runs = sum(x and not (i and m[i - 1]) for i, x in enumerate(m))
        out.append((len(t), sum(m), runs, hashlib.sha256(kept).hexdigest()))
    return out


def repetitive(n, seed):
    rnd = random.Random(seed)
    passages = ["".join(rnd.choice("abcé ") for _ in range(rnd.choice([30, 60, 200]))) for _ in range(6)]
    out = []
    for _ in range(n):
        kind = rnd.random()
        own = "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(80)))
        if kind < 0.5:
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) // 2)
            out.append(own + p[a:] + own[:3] + rnd.choice(passages))
        elif kind < 0.6:
            out.append(rnd.choice(["ab", "x", "abc"]) * rnd.randrange(60))
        elif kind < 0.7 and out:
            out.append(rnd.choice(out))
        else:
            out.append(own)
    return out


@pytest.mark.parametrize("length, gram, crowd", [(16, 5, 2048), (16, 5, 2), (16, 5, 0), (40, 8, 2048), (40, 8, 1)])
def test_report_matches_brute_force(docs_of, length, gram, crowd):
    texts = [*repetitive(160, length + crowd), None, "", "a" * 15, "b" * 16, "c" * 17]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in runindex.repeat_report(docs_of(list(enumerate(texts))), runindex.byte_rule(length, gram), crowd).collect()}
    assert [got[i] for i in range(len(texts))] == plain_report(texts, length)


def plain_word_texts(texts, length):
    """What remains without all words of windows that occur twice, blanks between removed words included."""
    out, count, split = [], Counter(), [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0d]+", (t or "").encode())] for t in texts]
    words = [[(t or "").encode()[a:b] for a, b in s] for t, s in zip(texts, split)]
    for w in words:
        count.update(tuple(w[i:i + length]) for i in range(len(w) - length + 1))
    for t, w, s in zip(texts, words, split):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(w) - length + 1):
            if count[tuple(w[i:i + length])] > 1:
                a, b = s[i][0], s[i + length - 1][1]
                gone[a:b] = b"\1" * (b - a)
        out.append(bytes(c for c, x in zip(raw, gone) if not x).decode())
    return out


@pytest.mark.parametrize("length, gram, crowd", [(6, 2, 2048), (6, 2, 1), (11, 3, 0)])
def test_words_match_brute_force(docs_of, length, gram, crowd):
    rnd = random.Random(length + crowd)
    passage = [" ".join(rnd.choice(["a", "bb", "é,", "dd\n", "e\t"]) for _ in range(rnd.randrange(30))) for _ in range(8)]
    texts = [rnd.choice(["", " ", "x "]) + " ".join(rnd.choice(passage)[rnd.randrange(9):] + f" own{i % 70}" for _ in range(rnd.randrange(4)))
             for i in range(150)] + [None, "", "a b c d e", "a b c d e"]
    want = plain_word_texts(texts, length)
    got = {r["doc_id"]: r["text"] for r in
           runindex.repeat_report(docs_of(list(enumerate(texts))), runindex.word_rule(length, gram), crowd).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sum(a != (b or "") for a, b in zip(want, texts)) > 20


def test_short_passages_of_many_words_go(docs_of):
    """51 words in fewer than 400 bytes, in two documents; 50 words stay."""
    words = [f"w{i}" for i in range(60)]
    docs = docs_of([(1, "one " + " ".join(words[:51]) + " end"), (2, "\n".join(words[:51])), (3, " ".join(words[5:55]) + " x")])
    got = {r["doc_id"]: r["text"] for r in runindex.remove_repeats(docs, runindex.word_rule()).collect()}
    assert got == {1: "one  end", 2: "", 3: " ".join(words[5:55]) + " x"}


def test_awkward_rows(awkward, no_docs):
    rows = runindex.repeat_report(awkward).collect()
    assert len(rows) == awkward.count()
    long = next(r for r in rows if r["doc_id"] == 4)
    assert long["n_removed"] == long["n_bytes"] and long["n_spans"] == 1
    assert sum(r["n_removed"] for r in rows if r["doc_id"] != 4) == 0
    assert runindex.repeat_report(no_docs).collect() == []


def test_rows_that_repeat_a_document_repeat_each_other(docs_of):
    text = "".join(f"{i} " for i in range(300))
    rows = runindex.repeat_report(docs_of([(1, text), (1, text), (2, text + "x"), (3, "z" + text[:399])])).collect()
    assert [(r["doc_id"], r["n_bytes"] - r["n_removed"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == \
        [(1, 0), (1, 0), (2, 1), (3, 400)]


def test_remove_repeats_keeps_columns_and_whole_characters(docs_of, awkward):
    shared = "é" * 20
    docs = docs_of([(1, "x" + shared, "en", "s", 21), (2, "y" + shared + "è", "fr", None, 22), (3, None, None, None, None)])
    got = {r["doc_id"]: r for r in runindex.remove_repeats(docs, runindex.byte_rule(16, 5)).collect()}
    assert (got[1]["text"], got[1]["n_chars"]) == ("x", 1)
    # the repeat reaches into the first byte of the last letter, so the letter goes with it
    assert (got[2]["text"], got[2]["lang"], got[2]["n_chars"]) == ("y", "fr", 1)
    assert got[3]["text"] is None and got[3]["n_chars"] is None
    kept = runindex.remove_repeats(awkward)
    assert kept.schema.names == awkward.schema.names and kept.count() == awkward.count()


@pytest.mark.parametrize("seed", range(6))
def test_index_marks_are_exact_for_any_texts(seed):
    rnd = random.Random(seed)
    texts = [t.encode() for t in repetitive(25, seed)] + [bytes(rnd.choice([0, 1, 255]) for _ in range(60))]
    texts = [t for t in texts if t]
    text, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])
    index = runindex.RunLengthIndex(text, ends, 12)
    assert index.lengths.sum() == len(text) and len(index.first) == len(index.last) == len(index.head)
    count = Counter(t[i:i + 12] for t in texts for i in range(len(t) - 11))
    want = []
    for t in texts:
        m = np.zeros(len(t), bool)
        for i in range(len(t) - 11):
            if count[t[i:i + 12]] > 1:
                m[i:i + 12] = True
        want.append(m)
    got = index.marked(12)
    assert np.array_equal(got, np.concatenate(want))


def test_long_texts_are_cut_into_pieces_without_loss(monkeypatch):
    monkeypatch.setattr(runindex, "PIECE", 50)
    ends = np.array([0, 10, 500, 500, 530])
    got = {}
    for row, a, b in runindex._pieces(ends, 16):
        for start in range(a, b - 15):
            assert got.setdefault((row, start), 1) == 1
            got[row, start] = 1
    want = {(r, s) for r, (a, b) in enumerate(zip(ends[:-1], ends[1:])) for s in range(a, b - 15)}
    assert set(got) == want

"""Packing documents into sequences of tokens by shortest-pack-first over the length histogram.

Documents are cut into full sequences; what is left of each, its tail, is shorter than a
sequence.  Tails are packed on their length histogram alone (its size is bounded by the
sequence's, whatever the corpus holds): lengths are placed longest first, each into
the packs with most room, and what is kept are patterns of lengths with their counts.
Patterns are joined back to the documents by rank: the tails of a length are numbered,
and each pattern owns a stretch of the numbers.

Packs that stay short would be padded.  So the emptiest ones are taken apart, and their
tails are cut where they fill the room of the others exactly; what remains in the end is laid into
sequences of a power of two, which need no padding either.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martline.llm.common import byte_texts, row_key, seen_filter, stored, with_offsets
from martline.llm.tokens import tokenizer_path

#: Tokens of a sequence, and the id that ends every document.
SIZE, END_ID = 2048, 1
#: Encoded words that a worker remembers, and bytes of text encoded together.
WORDS, TOGETHER = 1 << 19, 1 << 20
#: How a byte-level vocabulary writes a space.
SPACE = "\u0120"
#: A space between two characters that are white space by no table, and all white space but space and newline.
_BREAK = re.compile(r"(?<=[^\s\u180e\u200b\ufeff]) (?=[^\s\u180e\u200b\ufeff])")
_OTHER_BLANKS = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Letters that every version of Unicode takes for letters, and punctuation that belongs to no contraction.
_LETTERS, _MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", ",.;:!?"
#: Letters and punctuation, alone or with the like behind one newline.
_SIMPLE = re.compile(f"([{_LETTERS}]+)([{_MARKS}]*)(\n[{_LETTERS}]+[{_MARKS}]*)?")
#: What an added token must not look like for words to be learned in parts.
_PARTS = re.compile(f"[{_MARKS}\n]|^[{_LETTERS}]+$")
_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


# ---------------------------------------------------------------- tokens

def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes each byte: printable ones as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


def _spelled(letters: str) -> str:
    return letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_LETTERS)


class Words(dict):
    """Ids of a space and a word, by the word; learned when they are first asked for.

    The pre-tokenizer ends a run of letters at punctuation and at a newline, so words made of these are
    learned in parts, which other words share: letters go straight to the vocabulary's own merges.
    """

    def __init__(self, known):
        super().__init__()
        self._known = known
        added = [t.content for t in known.get_added_tokens_decoder().values()]
        self._marks = lru_cache(1 << 10)(self.encode)
        self._in_parts = known.normalizer is None and not any(_PARTS.search(t) for t in added)

    def encode(self, text: str) -> bytes:
        return np.array(self._known.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _merged(self, letters: str) -> bytes:
        ids = [t.id for t in self._known.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, word: str) -> bytes:
        found = _SIMPLE.fullmatch(word) if self._in_parts else None
        if found is None:
            ids = self.encode(" " + word)
        elif found[3]:  # two words around a newline seldom come back together
            before, after = word.split("\n")
            return self[before] + self._behind_newline(after)
        elif found[2]:
            ids = self[found[1]] + self._marks(found[2])
        else:
            ids = self._merged(SPACE + _spelled(word))
        self[word] = ids
        return ids

    def _behind_newline(self, word: str) -> bytes:
        letters = word.rstrip(_MARKS)
        marks = word[len(letters):]
        return self._marks("\n") + self._merged(_spelled(letters)) + (self._marks(marks) if marks else b"")


class Encoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    The byte-level pre-tokenizer starts a new word at every single space between
    characters that are no white space, so a text's ids are those of its words one after the
    other, and words that come back are not encoded again.
    """

    def __init__(self, tokenizer: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        from tokenizers import Tokenizer

        known = Tokenizer.from_file(tokenizer_path(tokenizer))
        known.no_truncation()
        known.no_padding()
        self._words = Words(known)

    @staticmethod
    def _split(text: str) -> list[str]:
        """The text's words, without the space before each."""
        if ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
                or _OTHER_BLANKS.search(text)):
            return _BREAK.split(text)
        return text.split(" ")

    def ids(self, texts: list[bytes]) -> list[bytes]:
        known, out = self._words, []
        for text in texts:
            first, *words = self._split(text.decode("utf-8", "replace"))
            if len(known) + len(words) > WORDS:  # the older half goes
                for word in list(islice(known, len(known) // 2)):
                    del known[word]
            out.append(known.encode(first) + b"".join(map(known.__getitem__, words)))
        return out


@lru_cache(1)
def worker_encoder(tokenizer: str) -> Encoder:
    """One encoder for all tasks of a worker, so its words are remembered."""
    return Encoder(tokenizer)


def encoded(column: pa.Array, encoder: Encoder) -> Iterator[bytes]:
    """Token ids of each row of a text column; a bounded number of bytes is encoded together."""
    texts, held = [], 0
    for text in byte_texts(column):
        texts.append(text)
        held += len(text)
        if held > TOGETHER:
            yield from encoder.ids(texts)
            texts, held = [], 0
    yield from encoder.ids(texts)


# ---------------------------------------------------------------- the plan

@dataclass
class Plan:
    """Where the tails of each length go, by rank; its size depends on the sequence's size only."""

    #: For each length, by rank: (first rank, tails of it in a pack, first line position or -1,
    #: first sequence, offset in the pack, tokens of the pack).
    places: dict[int, list[tuple[int, int, int, int, int, int]]] = field(default_factory=dict)
    #: Room on the line of cut tails: (line position, room, first sequence, offset there).
    rooms: list[tuple[int, int, int, int]] = field(default_factory=list)
    sequences: int = 0


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[tuple[int, int], ...], int, int]]:
    """(pattern, tokens, packs): patterns of (length, how many) with the number of packs that follow them.

    Longest lengths first, each into the packs with most room; packs that share a
    pattern are handled together.  A new pack is opened only where no pack has room.
    """
    packs: dict[int, dict[tuple, int]] = {}  # by room

    def put(room: int, pattern: tuple, n: int) -> None:
        at = packs.setdefault(room, {})
        at[pattern] = at.get(pattern, 0) + n

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max(packs, default=-1)
            if room < length:
                each = min(size // length, left)
                put(size - each * length, ((length, each),), left // each)
                if left % each:
                    put(size - left % each * length, ((length, left % each),), 1)
                break
            at = packs[room]
            pattern = min(at)
            n = min(at[pattern], left)
            at[pattern] -= n
            if not at[pattern]:
                del at[pattern]
            if not at:
                del packs[room]
            more = pattern[-1][1] + 1 if pattern[-1][0] == length else 1
            put(room - length, (pattern[:-1] if more > 1 else pattern) + ((length, more),), n)
            left -= n
    return [(pattern, size - room, n) for room, at in sorted(packs.items()) for pattern, n in sorted(at.items())]


def plan(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """The packs of all tails: full ones, ones filled up with cut tails, and a rest in powers of two."""
    packed = shortest_pack_first(histogram, size)
    out, rank = Plan(), dict.fromkeys(histogram, 0)
    short = sum(tokens * n for _, tokens, n in packed if tokens < size)
    filled = short // size  # the fullest short packs are filled up; what the others hold is enough for that
    line = 0
    rooms: list[tuple[int, int, int]] = []

    def place(pattern: tuple, tokens: int, n: int, first_line: int, first_sequence: int) -> None:
        offset = 0
        for length, each in pattern:
            out.places.setdefault(length, []).append((rank[length], each, first_line, first_sequence, offset, tokens))
            rank[length] += each * n
            offset += length * each

    for pattern, tokens, n in packed:  # fullest first
        kept = n if tokens == size else min(n, filled)
        if kept:
            place(pattern, tokens, kept, -1, out.sequences)
            if tokens < size:
                filled -= kept
                rooms.append((size - tokens, out.sequences, kept))
            out.sequences += kept
        if n > kept:
            place(pattern, tokens, n - kept, line, -1)
            line += tokens * (n - kept)
    at = 0
    for room, sequence, n in rooms:
        out.rooms.append((at, room, sequence, size - room))
        at += room * n
    for bit in reversed(range(size.bit_length())):
        if (line - at) & (1 << bit):
            out.rooms.append((at, 1 << bit, out.sequences, 0))
            at += 1 << bit
            out.sequences += 1
    return out


def _cuts(found: Plan, begins: list[int], at: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(tokens before, length, sequence, offset) of the pieces of a tail that lies on the line."""
    done = 0
    while done < length:
        base, room, sequence, offset = found.rooms[bisect_right(begins, at + done) - 1]
        number, within = divmod(at + done - base, room)
        take = min(room - within, length - done)
        yield done, take, sequence + number, offset + within
        done += take


# ---------------------------------------------------------------- the corpus

def _measured(docs: DataFrame, tokenizer: str, size: int, end_id: int) -> DataFrame:
    """(k1, k2, doc_id, n, crcs, tail_crc): tokens of each document and the checksums of its
    full sequences and of its tail."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for b in batches:
            n, crcs, tails = [], [], []
            for ids in encoded(b.column("text"), known):
                ids = memoryview(ids + end)
                full = len(ids) // (4 * size) * 4 * size
                n.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[a:a + 4 * size]) for a in range(0, full, 4 * size)])
                tails.append(zlib.crc32(ids[full:]))
            yield pa.RecordBatch.from_arrays(
                [b.column("k1"), b.column("k2"), b.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(crcs, pa.list_(pa.int64())), pa.array(tails, pa.int64())],
                ["k1", "k2", "doc_id", "n", "crcs", "tail_crc"])

    return (docs.select(*row_key(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "k1 long, k2 long, doc_id long, n long, crcs array<long>, tail_crc long"))


def _placed(tails: DataFrame, found: Plan, size: int) -> DataFrame:
    """Pieces of ranked tails; of cut ones the checksum is not known yet (null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins = [r[0] for r in found.rooms]
        firsts = {length: [p[0] for p in places] for length, places in found.places.items()}
        for b in batches:
            out = []
            for k1, k2, doc_id, n, crc, length, rank in zip(*(b.column(c).to_pylist() for c in (
                    "k1", "k2", "doc_id", "n", "tail_crc", "tail", "rank"))):
                first, each, line, sequence, offset, tokens = found.places[length][bisect_right(firsts[length], rank) - 1]
                pack, slot = divmod(rank - first, each)
                offset += slot * length
                if line < 0:
                    out.append((k1, k2, doc_id, n - length, length, crc, n, sequence + pack, offset))
                    continue
                for before, take, into, where in _cuts(found, begins, line + pack * tokens + offset, length):
                    out.append((k1, k2, doc_id, n - length + before, take, crc if take == length else None, n, into, where))
            columns = list(zip(*out)) or [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             ["k1", "k2", *(c.split()[0] for c in _PIECE.split(", "))])

    return tails.mapInArrow(run, f"k1 long, k2 long, {_PIECE}")


def _checksums(docs: DataFrame, cut: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Cut pieces with their checksums; only their documents are encoded once more."""
    known = seen_filter(cut, "k1")
    texts = (docs.select(*row_key(), F.col("text").cast("string").alias("text")).where(known(F.col("k1")))
             .groupBy("k1", "k2").agg(F.first("text").alias("text")))
    # a copy's pieces lie in one array for each of its rows, so no text is multiplied by its pieces
    names = [c.split()[0] for c in _PIECE.split(", ")]
    wanted = (cut.groupBy(F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.floor(F.col("sequence_id") / 4096))
              .agg(F.collect_list(F.struct(*names)).alias("pieces")))
    both = (texts.join(wanted, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")))
            .select("text", "pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for b in batches:
            for ids, pieces in zip(encoded(b.column("text"), encoder), b.column("pieces").to_pylist()):
                ids = memoryview(ids + end)
                for p in pieces:
                    p["ids_crc32"] = zlib.crc32(ids[4 * p["start"]:4 * (p["start"] + p["length"])])
                yield pa.RecordBatch.from_arrays([pa.array([p[c] for p in pieces], pa.int64()) for c in names], names)

    return both.mapInArrow(run, _PIECE)


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", size: int = SIZE,
                   end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its tokens and ``end_id``; a null text is empty, so every row has
    one token at least.  Sequences hold ``size`` tokens, only the last few a power of two, so
    none needs padding; they are numbered from 0 and filled from offset 0 without gaps.
    Repeated rows are documents of their own; null ids stay null; other columns are ignored.
    ``size`` is a power of two.
    """
    spark = docs.sparkSession
    every = stored(_measured(docs, tokenizer, size, end_id).withColumn("row", F.monotonically_increasing_id()), "token-lengths")
    tail = every.select("*", (F.col("n") % size).alias("tail")).where("tail > 0").drop("crcs")
    # at most size - 1 rows come back
    found = plan({r["tail"]: r["packs"] for r in tail.groupBy("tail").agg(F.count("*").alias("packs")).collect()}, size)
    ranked = with_offsets(tail.withColumn("one", F.lit(1).cast("long")), "tail", ["doc_id", "k1", "k2", "row"], "one", "rank")
    pieces = stored(_placed(ranked.select("k1", "k2", "doc_id", "n", "tail_crc", "tail", "rank"), found, size), "tail-pieces")
    long = every.where(F.size("crcs") > 0).select("doc_id", "n", "crcs", "row", F.size("crcs").cast("long").alias("full"),
                                                   F.lit(0).alias("all"))
    numbered = with_offsets(long, "all", ["row"], "full", "before")
    whole = (numbered.select("doc_id", "n", "before", F.posexplode("crcs").alias("at", "crc"))
             .select("doc_id", (F.col("at").cast("long") * size).alias("start"), F.lit(size).cast("long").alias("length"),
                     F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
                     (F.col("before") + F.col("at") + found.sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    done = pieces.where("ids_crc32 is not null").drop("k1", "k2")
    cut = pieces.where("ids_crc32 is null")
    return done.unionByName(whole).unionByName(_checksums(docs, cut, tokenizer, end_id))

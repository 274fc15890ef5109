"""Removal of long repeats with run-length compressed indexes.

Texts are sequences of symbols: their bytes, or their words by 64-bit hash.  Any two equal strings
of ``length`` symbols choose the same anchor: the place of the least hashed ``gram`` symbols
in them.  The strings that share an anchor lie in one stretch of text, its context, and equal
strings meet under the hash of their anchor.  Contexts that occur twice as a whole are
repeats; the different contexts of a common anchor are indexed together, anchors dealt over
shards of bounded size:

* the shard's suffixes are sorted, and its Burrows-Wheeler transform is kept as
  runs of equal letters with the suffix positions at both ends of each run;
* inside a run, neighbouring suffixes go on to the left with the same letter, so a
  longest match begins only at the ends of runs: match lengths are taken there;
* the matching statistics of the contexts are streamed from those samples (a position
  matches at least one symbol less than the position before it), and every symbol within
  a match of ``length`` or more is marked.

An anchor with more contexts than a shard holds is too common to tell them apart: its contexts are
anchored once more by longer grams, the last as long as the strings themselves, under
which only equal strings meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martline.llm.common import byte_texts, byte_view, row_key, seen_filter, stored

#: Symbols looked at together, windows of one piece of a long text, symbols of one index.
BUFFER, PIECE, SHARD = 1 << 20, 1 << 19, 1 << 19
#: Different contexts of an anchor that are indexed together; a context is shorter than two strings.
CROWD = 2048


@dataclass(frozen=True)
class Rule:
    """What a repeat is: ``length`` symbols (words, or else bytes), and the grams of its anchors."""

    length: int
    grams: tuple[int, ...]
    words: bool = False

    @property
    def size(self) -> int:
        """Bytes of a symbol."""
        return 8 if self.words else 1

    def symbols(self, text: bytes) -> np.ndarray:
        if not self.words:
            return np.frombuffer(text, np.uint8)
        # bytes.split() knows the six blanks of the word rule and no others
        found = text.split()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def byte_rule(length: int = 400, gram: int = 64) -> Rule:
    return Rule(length, (gram, (gram + length) // 2, length))


def word_rule(length: int = 51, gram: int = 8) -> Rule:
    return Rule(length, (gram, (gram + length) // 2, length), words=True)


_BASE = 0x9E3779B97F4A7C15 | 1
_SPAN = BUFFER + PIECE + 4096
_POWER = np.cumprod(np.full(_SPAN, _BASE, np.uint64))
_UNDO = np.cumprod(np.full(_SPAN, pow(_BASE, -1, 1 << 64), np.uint64))
_PLACE = np.uint64((1 << 24) - 1)


def _mixed(h: np.ndarray, by: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(by)
    return h ^ (h >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchor_runs(text: np.ndarray, valid: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, key) of every run of valid windows that share an anchor.

    ``valid`` says for every window start whether the window lies within one text.
    The key is a 64-bit hash of the anchor's string.
    """
    n = len(text) - gram + 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum((text.astype(np.uint64) + np.uint64(1)) * _POWER[:len(text)])])
    grams = (sums[gram:] - sums[:n]) * _UNDO[:n]
    rank = (_mixed(grams, 0xD6E8FEB86659FD93) & ~_PLACE) | np.arange(n, dtype=np.uint64)
    where = (_sliding_min(rank, length - gram + 1) & _PLACE).astype(np.int64)
    starts = np.flatnonzero(valid)
    owner = where[starts]
    new = np.append(True, (owner[1:] != owner[:-1]) | (np.diff(starts) > 1))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], starts[last], _mixed(_mixed(grams[owner[first]], 0xA0761D6478BD642F), _BASE).view(np.int64)


def _pieces(ends: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(row, begin, end): texts, long ones cut into pieces of PIECE windows that overlap."""
    for row, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
        for at in range(a, b - length + 1, PIECE):
            yield row, at, min(b, at + PIECE + length - 1)


def texts_of(docs: DataFrame) -> DataFrame:
    """(k1, k2, at, body): every text, as the whole of itself."""
    return docs.select(*row_key(), F.lit(0).alias("at"), F.col("text").cast("string").alias("body"))


def _sequences(column: pa.Array, rule: Rule) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of a column of texts, or of symbols written as binary, and where its rows begin and end."""
    if not rule.words:
        return byte_view(column)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        rows = [rule.symbols(t) for t in byte_texts(column)]
    else:
        rows = [np.frombuffer(t, np.uint64) for t in byte_texts(column)]
    return (np.concatenate([np.zeros(0, np.uint64), *rows]),
            np.concatenate([[0], np.cumsum([len(r) for r in rows], dtype=np.int64)]))


def contexts(parts: DataFrame, rule: Rule, gram: int) -> DataFrame:
    """(key, c1, c2, k1, k2, at, start, windows): every context of every part, with its 128-bit hash."""
    schema = "key long, c1 long, c2 long, k1 long, k2 long, at int, start int, windows int"
    length = rule.length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(raw, ends, k1, k2, from_, group: list[tuple[int, int, int]]) -> pa.RecordBatch:
            sizes = np.array([b - a for _, a, b in group])
            text = np.concatenate([raw[a:b] for _, a, b in group])
            begin = np.cumsum(sizes) - sizes
            valid = np.zeros(len(text) - length + 1, bool)
            for at, size in zip(begin.tolist(), sizes.tolist()):
                valid[at:at + size - length + 1] = True
            first, last, key = anchor_runs(text, valid, length, gram)
            view, size = memoryview(text).cast("B"), rule.size
            hashes = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a * size:(b + length) * size]) for a, b in
                                             zip(first.tolist(), last.tolist())]), np.int64).reshape(-1, 2)
            own = np.searchsorted(begin, first, "right") - 1
            rows = np.array([g[0] for g in group])[own]
            start = first - begin[own] + np.array([g[1] for g in group])[own] - ends[rows] + from_[rows]
            return pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(k1[rows]), pa.array(k2[rows]),
                 pa.array(from_[rows]), pa.array(start.astype(np.int32)), pa.array((last - first + 1).astype(np.int32))],
                ["key", "c1", "c2", "k1", "k2", "at", "start", "windows"])

        for b in batches:
            raw, ends = _sequences(b.column("body"), rule)
            keys = [b.column(c).to_numpy() for c in ("k1", "k2", "at")]
            group, held = [], 0
            for piece in _pieces(ends, length):
                if held and held + piece[2] - piece[1] > BUFFER:
                    yield emit(raw, ends, *keys, group)
                    group, held = [], 0
                group.append(piece)
                held += piece[2] - piece[1]
            if group:
                yield emit(raw, ends, *keys, group)

    return parts.select("k1", "k2", "at", "body").mapInArrow(run, schema)


# ---------------------------------------------------------------- one shard's index

class RunLengthIndex:
    """Run-length Burrows-Wheeler transform of a set of texts, suffix positions sampled at run ends.

    head, lengths: the runs; first, last: text positions of the suffixes at each run's
    ends.  ``least`` is the shortest match of interest.  Suffixes are sorted to the ends of
    their texts: only then does a run's inner pair go on to the left as neighbours.
    """

    def __init__(self, text: np.ndarray, ends: np.ndarray, least: int):
        letters, text = (256, text) if text.dtype == np.uint8 else (lambda u, i: (len(u), i))(*np.unique(text, return_inverse=True))
        n = len(text)
        begin = np.append(0, ends[:-1])
        # positions fit 32 bits: an index holds a bounded shard
        self.left = (np.repeat(ends, ends - begin) - np.arange(n)).astype(np.int32)  # symbols up to the own text's end
        self.bits = int(letters).bit_length()  # a letter is its rank + 1, zero lies beyond the end
        self.together = 63 // self.bits
        self.words = self._words(text.astype(np.int32))
        order, self.alike = self._sorted(int((ends - begin).max()), least)
        before = text[order - 1]
        starts = np.zeros(n, bool)
        starts[begin[begin < n]] = True
        edge = starts[order]  # a text's first suffix has no letter before it: a run of its own
        self.head = np.flatnonzero(np.append(True, (before[1:] != before[:-1]) | edge[1:] | edge[:-1]))
        self.lengths = np.diff(np.append(self.head, n))
        self.first = order[self.head]
        self.last = order[self.head + self.lengths - 1]

    def _words(self, text: np.ndarray) -> np.ndarray:
        """As many letters as fit 63 bits from every position, zeros beyond the end of the own text."""
        n = len(text)
        padded = np.concatenate([text, np.zeros(self.together, np.int32)])
        out = np.zeros(n, np.uint64)
        for i in range(self.together):
            letter = np.where(self.left > i, padded[i:i + n] + 1, 0).astype(np.uint64)
            out = (out << np.uint64(self.bits)) | letter
        return out

    def _sorted(self, depth: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix positions in order of their first ``depth`` letters, by prefix doubling, and groups
        within which all positions lie that agree in ``least`` letters."""
        n = len(self.words)
        order = np.argsort(self.words).astype(np.int32)
        key = self.words[order]
        new = np.append(True, key[1:] != key[:-1])
        del key
        slots, rank = np.arange(n, dtype=np.int32), np.empty(n, np.int32)
        rank[order] = np.maximum.accumulate(np.where(new, slots, 0))
        alike, sorted_to = rank.copy() if self.together <= least else np.zeros(n, np.int32), self.together
        while sorted_to < depth:
            if sorted_to <= least:
                alike[:] = rank
            again = slots[~(new & np.append(new[1:], True))]  # slots whose group is not single yet
            if not len(again):
                break
            pos = order[again]
            beyond = self.left[pos] > sorted_to
            after = np.where(beyond, rank[np.minimum(pos + sorted_to, n - 1)] + 1, 0)
            both = rank[pos].astype(np.uint64) * np.uint64(n + 1) + after.astype(np.uint64)
            by = np.argsort(both)
            order[again], both = pos[by], both[by]
            new[again] |= np.append(True, both[1:] != both[:-1])
            del pos, beyond, after, both, by
            rank[order[again]] = np.maximum.accumulate(np.where(new, slots, 0))[again]
            sorted_to *= 2
        return order, alike

    def _agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the suffixes at a and b have in common."""
        most = np.minimum(self.left[a], self.left[b]).astype(np.int64)
        out, todo, at = np.zeros(len(a), np.int64), np.arange(len(a)), 0
        while len(todo):
            x, y = a[todo] + at, b[todo] + at
            apart = self.words[x] ^ self.words[y]
            same = (apart == 0) & (most[todo] > at + self.together)
            done = todo[~same]
            equal = sum((apart[~same] >> np.uint64(self.bits * (self.together - i)) == 0).astype(np.int64)
                        for i in range(1, self.together + 1))
            out[done] = np.minimum(at + equal, most[done])  # equal leading letters of the word that differs
            todo, at = todo[same], at + self.together
        return out

    def matching_statistics(self, least: int) -> np.ndarray:
        """For each position the end of the match of ``least`` bytes or more that reaches furthest and
        begins there or before: sampled at run ends, then streamed from left to right."""
        n = len(self.left)
        reach = np.zeros(n, np.int64)
        if len(self.first) > 1:
            a, b = self.last[:-1], self.first[1:]
            near = (self.left[a] >= least) & (self.left[b] >= least) & (self.alike[a] == self.alike[b])
            a, b = a[near], b[near]
            common = self._agreement(a, b)
            long = common >= least
            np.maximum.at(reach, a[long], a[long] + common[long])
            np.maximum.at(reach, b[long], b[long] + common[long])
        return np.maximum.accumulate(reach)

    def marked(self, least: int) -> np.ndarray:
        """Bytes inside a string of at least ``least`` bytes that begins anywhere else as well."""
        return self.matching_statistics(least) > np.arange(len(self.left))


def spans(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of True."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


# ---------------------------------------------------------------- marks of the corpus

_CONTEXT = "key long, c1 long, c2 long, n long, contexts long, k1 long, k2 long, start int, windows int, context binary"
_MARK = "k1 long, k2 long, a int, b int"


def _fetched(parts: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """The symbols of the wanted contexts (at most one row for each, but for repeated input rows)."""
    known = seen_filter(wanted.select("k1"), "k1")
    names = ["key", "c1", "c2", "n", "contexts", "start", "windows"]
    lists = (wanted.groupBy("k1", "k2", "at").agg(F.collect_list(F.struct(*names)).alias("wanted"))
             .select(F.col("k1").alias("w1"), F.col("k2").alias("w2"), F.col("at").alias("w3"), "wanted"))
    joined = (parts.where(known(F.col("k1")))
              .join(lists, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & (F.col("at") == F.col("w3")))
              .select("k1", "k2", "at", "body", "wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, ends = _sequences(b.column("body"), rule)
            for k1, k2, at, begin, want in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                               ends.tolist(), b.column(4).to_pylist()):
                cols = {c: [w[c] for w in want] for c in names}
                body = [raw[begin + s - at:begin + s - at + w + rule.length - 1].tobytes()
                        for s, w in zip(cols["start"], cols["windows"])]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(cols[c], pa.int64()) for c in names[:5]), pa.array([k1] * len(want), pa.int64()),
                     pa.array([k2] * len(want), pa.int64()), *(pa.array(cols[c], pa.int32()) for c in names[5:]),
                     pa.array(body, pa.binary())], [c.split()[0] for c in _CONTEXT.split(", ")])

    return joined.mapInArrow(cut, _CONTEXT)


def _indexed(found: DataFrame, rule: Rule) -> DataFrame:
    """Marks within contexts whose anchor has other contexts, from one index for each bounded shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def index(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            text = np.frombuffer(b"".join(r[9] for r in rows), np.uint64 if rule.words else np.uint8)
            ends = np.cumsum([len(r[9]) // rule.size for r in rows])
            a, b = spans(RunLengthIndex(text, ends, rule.length).marked(rule.length))
            # a span may run over from one context into the next
            begin = np.append(0, ends[:-1])
            for lo, hi in zip(a.tolist(), b.tolist()):
                own = np.arange(np.searchsorted(ends, lo, "right"), np.searchsorted(ends, hi, "left") + 1)
                for i in own.tolist():
                    if rows[i][3] == 1:
                        s = rows[i][7] - int(begin[i])
                        out.append((rows[i][5], rows[i][6], max(lo, int(begin[i])) + s, min(hi, int(ends[i])) + s))
            if out:
                k1, k2, x, y = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                                                  pa.array(x, pa.int32()), pa.array(y, pa.int32())], ["k1", "k2", "a", "b"])
                out.clear()

        out: list[tuple] = []
        held: list[tuple] = []
        size = 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and row[:3] == held[-1][:3]:
                    continue  # the same context of a repeated input row
                if size > SHARD and row[0] != held[-1][0]:
                    yield from index(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[9]) // rule.size
        yield from index(held)

    return (found.repartition("key").sortWithinPartitions("key", "c1", "c2").mapInArrow(run, _MARK))


def repeats(docs: DataFrame, rule: Rule, crowd: int = CROWD) -> DataFrame:
    """(k1, k2, kind, a, b): what is known of a document's ranges of symbols.

    kind 0: a..b is covered by repeated strings.  Odd kinds, one for each length of grams: a context whose
    anchor occurs elsewhere spans a..b.  The even kind after it: the context that begins at a occurs
    just once as a whole.  So a document's repeated symbols are its ranges of kind 0 and the odd
    ones without an even one at the same place; rows are gathered by document once,
    and no join is needed to find the contexts that occur again.
    """
    parts, out = texts_of(docs), []
    span = (F.col("start") + F.col("windows") + rule.length - 1).alias("b")
    for level, gram in enumerate(rule.grams):
        every = stored(contexts(parts, rule, gram), "anchors")
        shared_keys = stored(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "shared-keys")
        known = seen_filter(shared_keys, "key")
        shared = stored(every.where(known(F.col("key"))).join(shared_keys, "key"), "shared-contexts")
        whole = stored(shared.groupBy("key", "c1", "c2").agg(F.count("*").alias("n"), F.min(
            F.struct("k1", "k2", "at", "start", "windows")).alias("one")).select("key", "c1", "c2", "n", "one.*"), "different-contexts")
        # stored before the join: an aggregate on its key would keep a hot anchor in one task
        several = stored(whole.groupBy("key").agg(F.count("*").alias("contexts")).where("contexts > 1"), "several")
        out += [shared.select("k1", "k2", F.lit(2 * level + 1).alias("kind"), F.col("start").alias("a"), span),
                whole.where("n = 1").select("k1", "k2", F.lit(2 * level + 2).alias("kind"), F.col("start").alias("a"), span)]
        if several.isEmpty():
            break
        found = stored(_fetched(parts, stored(whole.join(several, "key"), "wanted-contexts"), rule), "context-bytes")
        out.append(_indexed(found.where(F.col("contexts") <= crowd), rule).select("k1", "k2", F.lit(0).alias("kind"), "a", "b"))
        parts = found.where(F.col("contexts") > crowd).select("k1", "k2", F.col("start").alias("at"), F.col("context").alias("body"))
        if parts.isEmpty():
            break
    marks = out[0]
    for more in out[1:]:
        marks = marks.union(more)
    return marks


def _marked_docs(docs: DataFrame, rule: Rule, crowd: int, columns: list) -> DataFrame:
    """The chosen columns of every document, then its text and what is known of its ranges (null: nothing)."""
    marks = stored(repeats(docs, rule, crowd), "marks")
    lists = (marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("kind", "a", "b")).alias("ranges"))
             .select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), "ranges"))
    keyed = docs.select(F.struct(*columns).alias("row"), F.col("text").cast("string").alias("whole_text"), *row_key())
    return (keyed.join(lists, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left")
            .select("row", "whole_text", "ranges"))


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word begins and ends, in bytes."""
    raw = np.frombuffer(text, np.uint8)
    return spans((raw != 32) & ((raw < 9) | (raw > 13)))


def _kept(text: bytes, ranges: list[dict] | None, rule: Rule) -> tuple[bytes, int, int]:
    """(bytes that remain, bytes removed, maximal removed runs); of words, the blanks between them go too."""
    out, at, removed, runs = [], 0, 0, 0
    once = {(r["kind"], r["a"]) for r in ranges or () if r["kind"] and r["kind"] % 2 == 0}
    found = sorted((r["a"], r["b"]) for r in ranges or ()
                   if r["kind"] == 0 or r["kind"] % 2 and (r["kind"] + 1, r["a"]) not in once)
    if found and rule.words:
        begins, ends = word_places(text)
        found = [(int(begins[a]), int(ends[b - 1])) for a, b in found]
    for a, b in found:
        if a > at or not runs:
            out.append(text[at:a])
            runs += 1
            removed += b - a
        elif b > at:
            removed += b - at
        at = max(at, b)
    out.append(text[at:])
    return b"".join(out), removed, runs


def repeat_report(docs: DataFrame, rule: Rule = byte_rule(), crowd: int = CROWD) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (lowercase hex), text.

    A symbol is removed if a string of ``rule.length`` symbols that covers it also begins anywhere
    else in the UTF-8 texts, the same one included; matches don't cross documents, and all are
    judged on the input.  ``text`` is what remains, without characters that a cut has split.
    Null texts are empty; repeated rows are documents of their own (each repeats
    the other); null ids stay null; other columns are ignored.
    """
    ident = F.col("doc_id").cast("long").alias("doc_id")
    marked = _marked_docs(docs, rule, crowd, [ident]).select("row.doc_id", "whole_text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [(len(t), *_kept(t, r, rule)) for t, r in zip(byte_texts(b.column(1)), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([g[2] for g in got], pa.int64()),
                 pa.array([g[3] for g in got], pa.int64()), pa.array([hashlib.sha256(g[1]).hexdigest() for g in got], pa.string()),
                 pa.array([g[1].decode("utf-8", "ignore") for g in got], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])

    return marked.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string")


def remove_repeats(docs: DataFrame, rule: Rule = byte_rule(), crowd: int = CROWD) -> DataFrame:
    """The documents without their repeated symbols, all columns kept.

    A character that a removed range cuts in two goes with it; n_chars, if there is
    such a column, is the new text's length.  Untouched texts, nulls included, come back as they are.
    """
    names, schema = docs.columns, docs.schema
    marked = _marked_docs(docs, rule, crowd, [docs[f"`{c}`"] for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = []
            for text, ranges in zip(byte_texts(b.column(1)), b.column(2).to_pylist()):
                kept, removed, _ = _kept(text, ranges, rule)
                new.append(kept.decode("utf-8", "ignore") if removed else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], ["row", "new"])

    out = marked.mapInArrow(run, T.StructType([T.StructField("row", T.StructType(schema.fields)),
                                               T.StructField("new", T.StringType())]))
    old = {c: F.col("row").getField(c) for c in names}
    changed = {"text": F.coalesce("new", old["text"].cast("string"))}
    if "n_chars" in names:
        changed["n_chars"] = F.coalesce(F.char_length("new"), old["n_chars"]).cast(schema["n_chars"].dataType)
    return out.select(*[changed.get(c, old[c]).alias(c) for c in names])

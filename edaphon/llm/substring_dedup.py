"""Substring dedup by recompression.

A document's words are replaced by symbols in rounds. A round first names maximal runs of one symbol,
then names pairs: a coin thrown by a symbol's name puts it left or right, and a left symbol followed by
a right one becomes one symbol. Names are hashes of what they stand for, so every task gives the same
name to the same run or pair without asking, and equal passages get the same symbols except near
their ends: a boundary that survives a round depends on the two symbols beside it only. The span of
words a boundary depends on is carried along, so it is known exactly which boundaries any equal passage
must have.

Every window of ``window`` words is put under one of the boundaries that it determines: of those of the
highest round the one whose two symbols have the smallest name. Equal windows thus meet under equal
symbols. Neighbouring windows under one boundary travel as one row with a name for all their words:

1. Rows meet by the name of their boundary (Spark shuffles about one row per eight words). Rows alike
   in all words are one class, and all but its first row are repeats. A boundary with several classes
   leaves the first row of each open.
2. The windows of the open rows meet by their own 128-bit names.

Within a chunk of text equal rows are settled before the shuffle, so a passage in very many documents
sends one row per chunk. A boundary with ``WIDE`` or more classes in a chunk (a short common phrase) is
open anyway: its rows are dealt by class, and one marker tells the rows of other chunks. Documents are
joined to their repeated ranges last.

Defined cases: NULL text has no words; fewer words than a window are kept; windows are judged on the
input; rows without an id come before all others, by a hash of their text; rows that share an id are
one document (equal rows get equal answers, and ranges found in one of several texts under an id are
taken from each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import settled

WINDOW = 20
#: Rounds of runs and pairs. Each widens what a boundary depends on; two leave about half a window.
ROUNDS = 2
CHUNK_BYTES = 4_000_000
#: Characters of text per shuffle partition, whose rows a task holds at once (about 30 MB).
PART_CHARS = 40_000_000
NO_ID = -(2**63)
WIDE = 8
#: What a row is: to be decided; settled within its chunk; open anyway; a marker that its boundary is open.
PLAIN, SETTLED, OPEN, MARKER = 0, 1, 2, 3
ROW = "key bigint, span bigint, doc_id bigint, lo int, n int, state int"
A, B, C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def name(left: np.ndarray, right, seed: int = 0) -> np.ndarray:
    """The name of two symbols in a row, or of a symbol and its count."""
    x = left * A + (right ^ (right >> np.uint64(31))) * C + np.uint64((seed * 2 + 1) * int(B) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * B
    x = (x ^ (x >> np.uint64(27))) * C
    return x ^ (x >> np.uint64(31))


def word_names(words: list[bytes]) -> np.ndarray:
    import xxhash

    coded = pa.array(words, pa.large_binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return known[coded.indices.to_numpy()] if len(known) else np.zeros(0, np.uint64)


class Boundaries:
    """Boundaries between the symbols of a chunk of documents, after some half rounds.

    ``at``: word position; ``symbol``: name of the symbol that starts here; ``lo``, ``hi``: the words the
    boundary depends on; ``sure``: whether they determine it (ends of documents do not); ``edge``: start of
    a document, or the end of the chunk. ``key``: name of the symbols that decided it."""

    def __init__(self, names: np.ndarray, edges: np.ndarray):
        self.at = np.arange(len(names) + 1)
        self.symbol = np.r_[names, np.uint64(0)]
        self.lo, self.hi = self.at, self.at
        self.edge = np.zeros(len(self.at), dtype=bool)
        self.edge[edges] = self.edge[-1] = True
        self.sure = np.ones(len(self.at), dtype=bool)
        # before any round a boundary is anywhere; told apart by the words beside it
        self.key = name(np.r_[np.uint64(0), names], self.symbol)

    def keep(self, stays: np.ndarray, symbol: np.ndarray) -> None:
        """The next half round: boundaries that stay, and the new symbol that starts at each."""
        at = np.flatnonzero(stays)
        left, right = np.maximum(at - 1, 0), np.minimum(at + 1, len(stays) - 1)
        self.key = name(self.symbol[left], self.symbol[at])
        self.lo, self.hi = self.lo[left], self.hi[right]
        self.sure = self.sure[left] & self.sure[at] & self.sure[right] & ~self.edge[at]
        self.at, self.edge, self.symbol = self.at[at], self.edge[at], symbol

    def runs(self) -> None:
        stays = self.edge.copy()
        stays[1:] |= self.symbol[1:] != self.symbol[:-1]
        first = np.flatnonzero(stays)
        times = np.diff(np.r_[first, len(stays)]).astype(np.uint64)
        symbol = self.symbol[first]
        self.keep(stays, np.where(times > 1, name(symbol, times, 1), symbol))

    def pairs(self, round_: int) -> None:
        right = (name(self.symbol, np.array([round_], np.uint64), 2) >> np.uint64(40)) & np.uint64(1) == 1
        stays = np.ones(len(right), dtype=bool)
        stays[1:] = self.edge[1:] | right[:-1] | ~right[1:]
        first = np.flatnonzero(stays)
        symbol, double = self.symbol[first], np.diff(np.r_[first, len(stays)]) > 1
        symbol[double] = name(symbol[double], self.symbol[first[double] + 1], 3)
        self.keep(stays, symbol)


def anchors(names: np.ndarray, edges: np.ndarray, starts: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the position of its boundary and the boundary's name. ``starts`` ascend."""
    levels, found = [], Boundaries(names, edges)
    inside = found.at[1:-1]
    levels.append((inside, inside - 1, inside + 1, found.key[1:-1]))
    for round_ in range(ROUNDS):
        found.runs()
        found.pairs(round_)
        good = np.flatnonzero(found.sure & (found.hi - found.lo <= window))
        levels.append((found.at[good], found.lo[good], found.hi[good], found.key[good] ^ np.uint64(round_ + 1)))
    position, key = np.full(len(starts), -1), np.zeros(len(starts), np.uint64)
    rest = np.arange(len(starts))
    for at, lo, hi, keys in reversed(levels):
        # boundaries a window determines lie next to each other
        first = np.searchsorted(lo, starts[rest], side="left")
        last = np.searchsorted(hi, starts[rest] + window, side="right")
        rest, first, last = (x[last > first] for x in (rest, first, last)) if len(at) else (rest[:0], first[:0], last[:0])
        best = first.copy()
        for step in range(1, int((last - first).max()) if len(rest) else 0):
            more = np.flatnonzero(first + step < last)
            less = more[keys[first[more] + step] < keys[best[more]]]
            best[less] = first[less] + step
        position[rest], key[rest] = at[best], keys[best]
        rest = np.flatnonzero(position < 0)
    return position, key


def window_names(names: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The name of the ``window`` words from each position, built by doubling."""
    total, done, out, power = len(names), 0, None, names
    size = 1
    while True:
        if window & size:
            part = power[done : done + max(0, total - window + 1)]
            out = part if out is None else name(out[: len(part)], part, seed)
            done += size
        size *= 2
        if size > window:
            return out if out is not None else names[:0]
        power = name(power[: -size // 2], power[size // 2 :], seed + 10) if len(power) > size // 2 else power[:0]


def chunk_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]], np.ndarray]]:
    """(rows, words of each, sizes) for slices of about ``CHUNK_BYTES``; columns: doc_id, text, others."""
    for batch in batches:
        held, size, rows = [], 0, []
        for i in range(batch.num_rows):
            text = batch.column(1)[i].as_py() or ""
            held.append(text.encode().split())
            rows.append(i)
            size += len(text)
            if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                yield [batch.column(0)[k].as_py() for k in rows], held, batch.slice(rows[0], len(rows))
                held, size, rows = [], 0, []


def first_of(order_by: tuple[np.ndarray, ...], doc: np.ndarray, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted order by class and place, whether a row opens its class, and whether it lies later than the first."""
    order = np.lexsort((lo, doc, *reversed(order_by)))
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for x in order_by:
        same &= x[order[1:]] == x[order[:-1]]
    opens = np.r_[True, ~same][: len(order)]
    first = np.flatnonzero(opens)
    which = np.cumsum(opens) - 1
    head = order[first][which] if len(order) else order
    later = (doc[order] != doc[head]) | (lo[order] != lo[head])
    return order, opens, later


def document_id(id: str, text: str) -> Column:
    """The id, or for rows without one a number below all ids, by a hash of the text."""
    own = F.lit(NO_ID) + F.pmod(F.xxhash64(F.col(text).cast("string")), F.lit(1 << 40))
    return F.coalesce(F.col(id).cast("long"), own)


def record(key, span, doc, lo, n, state) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(key.astype(np.uint64, copy=False).view(np.int64)), pa.array(span.astype(np.uint64, copy=False).view(np.int64)),
            pa.array(doc), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(state.astype(np.int32)),
        ],
        ["key", "span", "doc_id", "lo", "n", "state"],
    )


def sent(key, span, doc, lo, n) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk: the first of each class under its key, repeats as settled ones under any key."""
    if not len(key):
        return
    order, opens, later = first_of((key, span, n), doc, lo)
    pick = opens | later
    rows, later, opens = order[pick], later[pick], opens[pick]
    key, span, doc, lo, n = (x[rows] for x in (key, span, doc, lo, n))
    new_key = np.r_[True, key[1:] != key[:-1]]
    group = np.cumsum(new_key) - 1
    wide = np.bincount(group, opens)[group] >= WIDE
    state = np.where(later, SETTLED, np.where(wide, OPEN, PLAIN))
    mark = np.flatnonzero(new_key & wide)
    if len(mark):
        yield record(key[mark], np.zeros(len(mark)), doc[mark], lo[mark], np.full(len(mark), -1), np.full(len(mark), MARKER))
    key = np.where(later, name(doc.view(np.uint64), lo.astype(np.uint64)), np.where(wide, name(key, span, 5), key))
    yield record(key, span, doc, lo, n, state)


def boundary_rows(docs: DataFrame, window: int) -> DataFrame:
    """One row per run of windows under one boundary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, _ in chunk_words(batches):
            sizes = np.array([len(w) for w in words])
            ends = np.cumsum(sizes)
            begin = ends - sizes
            names = word_names([w for ws in words for w in ws])
            counts = np.maximum(sizes - window + 1, 0)
            if not counts.sum():
                continue
            which = np.repeat(np.arange(len(sizes)), counts)
            starts = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[which]
            position, key = anchors(names, begin[sizes > 0], starts, window)
            whole = window_names(names, window, 0)
            opens = np.flatnonzero(np.r_[True, (np.diff(position) != 0) | (np.diff(which) != 0) | (np.diff(key) != 0)])
            n = np.diff(np.r_[opens, len(starts)])
            # the first and the last window cover all words of the run
            span = name(name(whole[starts[opens]], whole[starts[opens] + n - 1]), n.astype(np.uint64), 4)
            doc = np.array(ids, dtype=np.int64)
            yield from sent(key[opens], span, doc[which[opens]], starts[opens] - begin[which[opens]], n)

    return docs.mapInArrow(run, ROW)


def window_rows(opened: DataFrame, window: int) -> DataFrame:
    """One row per window of the open ranges (columns doc_id, text, ranges), under its 128-bit name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, words, rows in chunk_words(batches):
            names = word_names([w for ws in words for w in ws])
            sizes = np.array([len(w) for w in words])
            begin = np.cumsum(sizes) - sizes
            ranges = rows.column(2).to_pylist()
            pairs = [(i, r["lo"], r["n"]) for i, rs in enumerate(ranges) for r in rs]
            which, lo, n = (np.array(x, dtype=np.int64) for x in zip(*pairs))
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            which = np.repeat(which, n)
            fits = place + window <= sizes[which]
            which, place = which[fits], place[fits]
            at = begin[which] + place
            doc = np.array(ids, dtype=np.int64)
            yield from sent(
                window_names(names, window, 0)[at], window_names(names, window, 7)[at], doc[which], place, np.ones(len(at), np.int64)
            )

    return opened.mapInArrow(run, ROW)


def gathered(batches: Iterator[pa.RecordBatch], settled_rows) -> Iterator:
    """Passes rows that are settled on to ``settled_rows`` and returns the others as arrays, or None."""
    held = []
    for batch in batches:
        *columns, state = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        known = state == SETTLED
        if known.any():
            yield settled_rows(*(x[known] for x in columns))
        held.append([x[~known] for x in (*columns, state)])
    return [np.concatenate(x) for x in zip(*held)] if held else None


def repeats(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_id, lo, n, open): repeated ranges of windows, and first ranges of boundaries with several classes."""

    def out(doc, lo, n, is_open) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(n), pa.array(np.full(len(doc), is_open))], ["doc_id", "lo", "n", "open"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = yield from gathered(batches, lambda key, span, doc, lo, n: out(doc, lo, n, False))
        if held is None:
            return
        key = held[0]
        # names that stand alone need no order
        order = np.argsort(key, kind="stable")
        edge = np.r_[True, key[order][1:] != key[order][:-1], True] if len(key) else np.zeros(1, dtype=bool)
        some = order[~(edge[:-1] & edge[1:]) | (held[5][order] == OPEN)]
        key, span, doc, lo, n, state = (x[some] for x in held)
        if not len(key):
            return
        order, opens, later = first_of((key, span, n), doc, lo)
        later &= state[order] != MARKER
        yield out(doc[order][later], lo[order][later], n[order][later], False)
        first = order[opens]
        edge = np.r_[True, key[first][1:] != key[first][:-1], True]
        several = first[(~(edge[:-1] & edge[1:]) & (state[first] != MARKER)) | (state[first] == OPEN)]
        if len(several):
            yield out(doc[several], lo[several], n[several], True)

    return rows.repartition(parts, "key").mapInArrow(run, "doc_id bigint, lo int, n int, open boolean")


def by_document(ranges: DataFrame) -> DataFrame:
    return ranges.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list(F.struct("lo", "n")).alias("ranges"))


def repeated_ranges(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, lo, n): runs of windows that also start earlier; doc_id is ``document_id``."""
    rows = docs.select(document_id(id, text).alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_CHARS))
    found = settled(repeats(boundary_rows(rows, window), parts), "repeats")
    opened = rows.join(by_document(found.filter("open")), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "ranges")
    more = settled(repeats(window_rows(opened, window), parts), "open-repeats")
    return found.filter("not open").unionByName(more.filter("not open")).drop("open")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined by one space)."""
    ranges = by_document(repeated_ranges(docs, id, text, window))
    plain = docs.drop("n_words", "n_removed", "kept_text")
    joined = plain.join(ranges, document_id(id, text) == F.col("_id"), "left").drop("_id")
    names = plain.columns
    schema = plain.schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ranges_ = batch.column(names.index(text)), batch.column(len(names))
            sizes, removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = (texts[i].as_py() or "").encode().split()
                found = ranges_[i].as_py()
                if found:
                    change = np.zeros(len(words) + 1, dtype=np.int64)
                    lo = np.minimum(np.array([r["lo"] for r in found]), len(words))
                    np.add.at(change, lo, 1)
                    np.add.at(change, np.minimum(lo + np.array([r["n"] for r in found]) + window - 1, len(words)), -1)
                    stays = np.cumsum(change)[:-1] == 0
                    words_kept = [w for w, s in zip(words, stays.tolist()) if s]
                else:
                    words_kept = words
                sizes.append(len(words))
                removed.append(len(words) - len(words_kept))
                kept.append(b" ".join(words_kept).decode())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                [*names, "n_words", "n_removed", "kept_text"],
            )

    return joined.mapInArrow(run, schema)



def removal_sql(window: int = WINDOW) -> str:
    """``remove_repeats`` over ``documents`` in DuckDB's SQL, with the digest of the kept text."""
    return f"""
with spoken as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') ws from documents
),
windows as (
  select doc_id, i, array_to_string(ws[i:i + {window - 1}], ' ') words
  from (select doc_id, ws, unnest(range(1, len(ws) - {window - 2})) i from spoken)
),
later as (select doc_id, i from windows qualify row_number() over (partition by words order by doc_id, i) > 1),
gone as (select doc_id, list(distinct j) js from (select doc_id, unnest(range(i, i + {window})) j from later) group by doc_id),
kept as (
  select s.doc_id, len(ws) n_words, coalesce(len(js), 0) n_removed,
    case when js is null then ws else list_filter(ws, lambda w, j: not list_contains(js, j)) end kept
  from spoken s left join gone g on s.doc_id = g.doc_id
)
select doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) kept_sha256 from kept"""

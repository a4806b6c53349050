"""Near-duplicate lines by a deletion-neighbourhood join.

The unit of an edit is a word. Two lines are alike if they are equal, or if both have at least
``MIN_WORDS`` words and one insertion, deletion or substitution of a word turns one into the other. A
line goes if an alike line stands earlier (smaller doc_id, or same document, further up); this is judged on
the input, so the earliest of alike lines always stays.

1. Equal lines meet by the name of their words.
2. One edit leaves the first or the last half of the words as they were. Lines that share neither with
   any other line have no partner, and only the others put out variants, on the side the edit can be.
3. Variants: the line without its i-th word, keyed with place and length (equal keys: a substitution at
   i), and keyed as a line (equal to a whole shorter line: a deletion). Equal keys join; a key is 128
   bits made from the words on both sides of the edit, so equal keys verify one edit. In each group the
   earliest row, or for deletions the earliest of the other kind, decides.

Every group is settled within a chunk of text first, and a chunk sends what can still decide for
others: a line or template that stands in very many documents is one row per chunk.

Defined cases: NULL and empty texts have no lines; lines without words stay and are not compared; white
space inside a line does not count; rows without an id come before all others, by a hash of their text;
rows that share an id are one document (lines found in one of several texts under an id go from each).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import settled
from edaphon.llm.substring_dedup import (
    PART_CHARS, PLAIN, ROW, SETTLED, document_id, first_of, gathered, name, record, sent, word_names,
)

MIN_WORDS = 8
CHUNK_BYTES = 4_000_000
#: What shares a half: lines of this many words or one less; first or last half.
SIDES = ((0, False), (0, True), (1, False), (1, True))
EQUAL = len(SIDES)
SUBSTITUTED, SHORTENED, WHOLE = 0, 1, 2
BASES = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD1342543DE82EF95))


class Lines:
    """The lines with words of a chunk of documents. ``begin``, ``end``: word positions; ``doc``, ``line``: where
    it stands; ``row``: which text; sums over powers give the name of any run of words."""

    def __init__(self, ids: list[int], texts: list[str | None], wanted: list[list[int] | None] | None = None):
        words, sizes, docs, places, rows = [], [], [], [], []
        for k, (doc, text) in enumerate(zip(ids, texts)):
            lines = (text or "").encode().split(b"\n")
            for i in range(len(lines)) if wanted is None else wanted[k]:
                found = lines[i].split() if i < len(lines) else []
                if found:
                    words += found
                    sizes.append(len(found))
                    docs.append(doc)
                    rows.append(k)
                    places.append(i)
        self.size = np.array(sizes, dtype=np.int64)
        self.doc, self.line = np.array(docs, dtype=np.int64), np.array(places, dtype=np.int64)
        self.row = np.array(rows, dtype=np.int64)
        self.end = np.cumsum(self.size)
        self.begin = self.end - self.size
        names, self.sums, self.back = word_names(words), [], []
        for base in BASES:
            power = np.cumprod(np.r_[np.uint64(1), np.full(len(names) + 1, base)])
            self.back.append(np.cumprod(np.r_[np.uint64(1), np.full(len(names) + 1, np.uint64(pow(int(base), -1, 2**64)))]))
            self.sums.append(np.r_[np.uint64(0), np.cumsum(names * power[: len(names)])])

    def run(self, which: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Name of the words from a to b."""
        return (self.sums[which][b] - self.sums[which][a]) * self.back[which][a]

    def without(self, which: int, a: np.ndarray, b: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Name of the words from a to b except the one at i, as if they were a line."""
        sums, back = self.sums[which], self.back[which]
        return (sums[i] - sums[a]) * back[a] + (sums[b] - sums[i + 1]) * back[a + 1]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about ``CHUNK_BYTES`` of text (second column)."""
    for batch in batches:
        start, size = 0, 0
        lengths = pc.binary_length(batch.column(1)).to_pylist()
        for i, length in enumerate(lengths):
            size += length or 0
            if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0


def line_rows(docs: DataFrame, min_words: int) -> DataFrame:
    """A row per line under the name of its words (``n``: ``EQUAL``), and one per half under the half's name (``n``:
    place in ``SIDES``). Settled rows have an equal line before them, or another line with the same half, in
    the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            x = Lines(rows.column(0).to_pylist(), rows.column(1).to_pylist())
            whole, span = (name(x.run(w, x.begin, x.end), x.size.astype(np.uint64), w) for w in range(2))
            yield from sent(whole, span, x.doc, x.line, np.full(len(whole), EQUAL))
            parts = []
            for side, (less, last) in enumerate(SIDES):
                base = x.size - less
                at = np.flatnonzero(base >= min_words)
                half, a, b = base[at] // 2, x.begin[at], x.end[at]
                part = x.run(0, b - half, b) if last else x.run(0, a, a + half)
                parts.append((name(part, (base[at] * 2 + last).astype(np.uint64), 5), whole[at], at, np.full(len(at), side)))
            key, span, at, side = (np.concatenate(p) for p in zip(*parts))
            if not len(key):
                continue
            order = np.lexsort((x.line[at], x.doc[at], span, key))
            key, span, at, side = key[order], span[order], at[order], side[order]
            new_key = np.r_[True, key[1:] != key[:-1]]
            new_line = new_key | np.r_[True, span[1:] != span[:-1]]
            group = np.cumsum(new_key) - 1
            several = np.bincount(group, new_line)[group] > 1
            # two different lines speak for the chunk, so that others learn that the half is shared; for the
            # lines of the chunk that is settled, by rows of their own
            nth = np.cumsum(new_line)
            speaks = np.flatnonzero(new_line & (nth - nth[np.flatnonzero(new_key)][group] < 2))
            told = np.flatnonzero(new_line & several)
            spread = name(x.doc[at[told]].view(np.uint64), (x.line[at[told]] * 4 + side[told]).astype(np.uint64))
            for pick, keys, state in ((speaks, key[speaks], PLAIN), (told, spread, SETTLED)):
                yield record(keys, span[pick], x.doc[at[pick]], x.line[at[pick]], side[pick], np.full(len(pick), state))

    return docs.mapInArrow(run, ROW)


def met_lines(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_id, lo, n): lines with an equal one earlier (``EQUAL``), and lines whose half is that of another line too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(doc, lo, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo), pa.array(n)], ["doc_id", "lo", "n"])

        held = yield from gathered(batches, lambda key, span, doc, lo, n: out(doc, lo, n))
        if held is not None:
            equal = held[4] == EQUAL
            key, span, doc, lo, n = (x[equal] for x in held[:5])
            order, _, later = first_of((key, span), doc, lo)
            yield out(doc[order][later], lo[order][later], n[order][later])
            key, span, doc, lo, n = (x[~equal] for x in held[:5])
            order = np.lexsort((span, key))
            key, span = key[order], span[order]
            new_key = np.r_[True, key[1:] != key[:-1]][: len(key)]
            new_line = new_key | np.r_[True, span[1:] != span[:-1]][: len(key)]
            group = np.cumsum(new_key) - 1
            mine = order[np.bincount(group, new_line)[group] > 1] if len(key) else order
            yield out(doc[mine], lo[mine], n[mine])

    return rows.repartition(parts, "key").mapInArrow(run, "doc_id bigint, lo int, n int")


def earlier_alike(key, span, doc, lo, kind) -> np.ndarray:
    """Whether an alike row lies earlier, by variants that meet."""
    order, opens, later = first_of((key, span), doc, lo)
    group = np.cumsum(opens) - 1
    kind_, place = kind[order], np.arange(len(order))
    first = np.full((2, len(opens) and group[-1] + 1), len(order))
    for k, wanted in enumerate((SHORTENED, WHOLE)):
        rows = np.flatnonzero(kind_ == wanted)
        np.minimum.at(first[k], group[rows], rows)
    other = np.where(kind_ == SHORTENED, first[1][group], first[0][group]) if len(order) else place
    # rows of one place are not earlier than each other
    at = np.minimum(other, max(len(order) - 1, 0))
    before = (other < place) & ((doc[order][at] != doc[order]) | (lo[order][at] != lo[order]))
    out = np.zeros(len(order), dtype=bool)
    out[order] = np.where(kind_ == SUBSTITUTED, later, before)
    return out


def variant_rows(opened: DataFrame, min_words: int) -> DataFrame:
    """Variants of the lines in ``ranges`` (lo: line, n: side); columns doc_id, text, ranges. settled rows
    have an alike line earlier in their chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            sides: list[dict[int, int]] = []
            for ranges in rows.column(2).to_pylist():
                sides.append({})
                for r in ranges:
                    sides[-1][r["lo"]] = sides[-1].get(r["lo"], 0) | 1 << r["n"]
            x = Lines(rows.column(0).to_pylist(), rows.column(1).to_pylist(), [sorted(found) for found in sides])
            flags = np.array([sides[k][i] for k, i in zip(x.row.tolist(), x.line.tolist())], dtype=np.int64)
            if not len(flags):
                continue
            made = []
            for kind, (front, back), less in ((SUBSTITUTED, (1, 2), 0), (SHORTENED, (4, 8), 1)):
                half = (x.size - less) // 2
                # the first half is shared: the edit is behind it; the last half is shared: before it
                lo = np.where(flags & back, 0, half)
                hi = np.where(flags & front, x.size, x.size - half)
                n = np.where(flags & (front | back), np.maximum(hi - lo, 0), 0)
                which = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + lo[which]
                a, b = x.begin[which], x.end[which]
                keys = [x.without(w, a, b, a + i) for w in range(2)]
                length = (x.size[which] - 1).astype(np.uint64)
                if kind == SUBSTITUTED:
                    keys = [name(name(k, length, 8 + w), i.astype(np.uint64), 6) for w, k in enumerate(keys)]
                else:
                    keys = [name(k, length, 8 + w) for w, k in enumerate(keys)]
                made.append((*keys, which, np.full(len(which), kind)))
            whole = np.flatnonzero(flags & 3)
            keys = [name(x.run(w, x.begin[whole], x.end[whole]), x.size[whole].astype(np.uint64), 8 + w) for w in range(2)]
            made.append((*keys, whole, np.full(len(whole), WHOLE)))
            key, span, which, kind = (np.concatenate(p) for p in zip(*made))
            doc, lo = x.doc[which], x.line[which]
            known = earlier_alike(key, span, doc, lo, kind)
            # lines that go are told once; their variants can decide for others only as the first of their kind
            order, opens, _ = first_of((key, span, kind), doc, lo)
            gone = np.zeros(len(x.size), dtype=bool)
            gone[which[known]] = True
            goes = np.zeros(len(key), dtype=bool)
            goes[order[opens]] = True
            goes |= (kind != SUBSTITUTED) & ~gone[which]
            told = np.flatnonzero(gone)
            spread = name(x.doc[told].view(np.uint64), x.line[told].astype(np.uint64))
            yield record(key[goes], span[goes], doc[goes], lo[goes], kind[goes], np.full(int(goes.sum()), PLAIN))
            yield record(spread, spread, x.doc[told], x.line[told], np.zeros(len(told)), np.full(len(told), SETTLED))

    return opened.mapInArrow(run, ROW)


def near_repeats(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_id, lo): lines with an alike line earlier."""

    def out(doc, lo) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(lo)], ["doc_id", "lo"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = yield from gathered(batches, lambda key, span, doc, lo, n: out(doc, lo))
        if held is not None:
            key, span, doc, lo, n, _ = held
            goes = earlier_alike(key, span, doc, lo, n)
            yield out(doc[goes], lo[goes])

    return rows.repartition(parts, "key").mapInArrow(run, "doc_id bigint, lo int").distinct()


def repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, lo, near): lines that go; ``near`` if no equal line stands earlier; doc_id is ``document_id``."""
    rows = docs.select(document_id(id, text).alias("doc_id"), F.col(text).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_CHARS))
    met = settled(met_lines(line_rows(rows, min_words), parts), "met-lines")
    equal, halves = met.filter(F.col("n") == EQUAL).select("doc_id", "lo"), met.filter(F.col("n") != EQUAL)
    sides = halves.groupBy(F.col("doc_id").alias("_id")).agg(F.collect_set(F.struct("lo", "n")).alias("ranges"))
    opened = rows.join(sides, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "ranges")
    near = settled(near_repeats(variant_rows(opened, min_words), parts), "near-lines")
    both = equal.withColumn("near", F.lit(False)).unionByName(near.withColumn("near", F.lit(True)))
    return both.groupBy("doc_id", "lo").agg(F.min("near").alias("near"))


def remove_repeated_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``n_lines`` (with words), ``n_equal`` and ``n_near`` (lines that go) and ``kept_text``."""
    gone = repeated_lines(docs, id, text, min_words).groupBy(F.col("doc_id").alias("_id"))
    gone = gone.agg(F.collect_list("lo").alias("_gone"), F.sum((~F.col("near")).cast("long")).alias("_equal"))
    plain = docs.drop("n_lines", "n_equal", "n_near", "kept_text")
    joined = plain.join(gone, document_id(id, text) == F.col("_id"), "left").drop("_id")
    names = plain.columns
    schema = plain.schema.add("n_lines", "long").add("n_equal", "long").add("n_near", "long").add("kept_text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists, equal = (batch.column(k) for k in (names.index(text), len(names), len(names) + 1))
            out: list[tuple[int, int, int, str]] = []
            for i in range(batch.num_rows):
                body, found, n_equal = texts[i].as_py() or "", lists[i].as_py() or [], equal[i].as_py() or 0
                lines, drop = body.split("\n"), set(found)
                n_lines = sum(bool(line.encode().split()) for line in lines)
                kept = "\n".join([line for k, line in enumerate(lines) if k not in drop]) if drop else body
                out.append((n_lines, n_equal, len(drop) - n_equal, kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            more = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *more], [*names, "n_lines", "n_equal", "n_near", "kept_text"])

    return joined.mapInArrow(run, schema)

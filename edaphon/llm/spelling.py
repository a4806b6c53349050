"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are counted over all texts first (sums per chunk of text, then one shuffle). A word becomes the
counts of its letters; one inserted or deleted letter moves these by one, a replaced letter by two (L1).
So per length the words live in a k-d tree over letter counts, and a word's partners of its own length
lie in boxes at distance two at most, those of the next length in boxes at distance one.

The upper tree is fitted on a bounded sample of words (``SAMPLE``; where it cuts decides speed, not
results) and deals all words to cells, a cell to blocks of at most ``BLOCK`` words. A block looks up the
cells near its box, is joined to their blocks, and sends each of them only the words within reach of its true
box. Blocks then receive words in a sorted stream, each with a k-d tree of its own: ranges of words walk down the
boxes, what meets in a leaf is compared by a 64-bit code of its letter counts, and what is left by the
order of its letters. Every pair of blocks meets once. No pair is left out and none is written: a block puts
out per word how many partners it found and the most frequent of them.

Defined cases: NULL and empty texts have no words; rows without an id spell the empty string for it; rows
that repeat count as often as they occur; other columns are ignored whatever their names; an empty table
gives no rows; words of any length take part (letter counts stop at 127, which only widens the search); among partners of equal count
the first in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

LEAST_LETTERS, LEAST_USES, FORM_TIMES, SLIP = 7, 2, 10, 31
#: Words the upper trees are fitted on, words per cell that they aim at, words of a block and of a leaf.
SAMPLE, CELL, BLOCK, LEAF = 65_536, 12_288, 24_576, 64
#: Pairs of codes compared at a time.
TABLE = 2_000_000
#: Different words a task counts before it passes them on.
COUNTED = 400_000
DIMS = 32

_LOWER = {c: c + 32 for c in range(65, 91)}
#: Letter -> dimension: a-z on their own, accented letters in six groups (which only lessens distances).
_DIM = np.array([b - 97 if 97 <= b <= 122 else 26 + b % 6 for b in range(256)], dtype=np.int64)


def spelled(doc_id: int | None, run: str) -> str:
    """The run of a document as it is counted: one in ``SLIP`` loses a letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all words long and frequent enough."""
    # what is shorter than this cannot be long enough after losing a letter, nor before
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LEAST_LETTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, body in zip(batch.column("id").to_pylist(), batch.column("text")):
                own: Counter[str] = Counter()
                for found, n in Counter(runs.findall(body.as_py())).items():
                    own[found.lower() if found.isascii() else found.translate(_LOWER)] += n
                for found, n in own.items():
                    word = spelled(doc_id, found)
                    if len(word) >= LEAST_LETTERS:
                        total[word] += n
                if len(total) >= COUNTED:
                    yield out()
                    total.clear()
        if total:
            yield out()

    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).filter(F.length("text") >= LEAST_LETTERS)
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_USES)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as rows of letters."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def letter_counts(rows: np.ndarray) -> np.ndarray:
    at = _DIM[rows] + DIMS * np.arange(len(rows))[:, None]
    return np.minimum(np.bincount(at.ravel(), minlength=DIMS * len(rows)), 127).astype(np.int8).reshape(-1, DIMS)


def codes(counts: np.ndarray) -> np.ndarray:
    """Two bits a dimension (one or more, two or more): codes differ in no more bits than counts in steps."""
    bits = np.stack([counts >= 1, counts >= 2], axis=2).reshape(len(counts), 2 * DIMS)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def halves(counts: np.ndarray) -> tuple[int, int] | None:
    """(dimension, greatest value of the lower side) that cuts best, if any does."""
    dim = int(counts.var(axis=0).argmax())
    column = counts[:, dim]
    low, high = int(column.min()), int(column.max())
    return None if low == high else (dim, min(int(np.median(column)), high - 1))


Cell = tuple[np.ndarray, np.ndarray]


class UpperTree:
    """Per length: a tree of cuts, and its cells as regions."""

    def __init__(self, sample: list[str], words: int):
        share = max(1.0, words / max(1, len(sample)))
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        self.cuts: dict[int, tuple | int] = {}
        self.regions: dict[int, Cell] = {}
        for length, found in by_length.items():
            cells: list[Cell] = []
            self.cuts[length] = self._grow(letter_counts(letters(found)), share, cells, np.zeros(DIMS, np.int16), np.full(DIMS, 127, np.int16))
            self.regions[length] = np.array([c[0] for c in cells]), np.array([c[1] for c in cells])

    def _grow(self, counts: np.ndarray, share: float, cells: list[Cell], low: np.ndarray, high: np.ndarray) -> tuple | int:
        cut = halves(counts) if len(counts) * share > CELL and len(counts) > 1 else None
        if cut is None:
            cells.append((low, high))
            return len(cells) - 1
        dim, at = cut
        under, over = high.copy(), low.copy()
        under[dim], over[dim] = at, at + 1
        side = counts[:, dim] <= at
        return dim, at, self._grow(counts[side], share, cells, low, under), self._grow(counts[~side], share, cells, over, high)

    def cell_of(self, length: int, counts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(counts), dtype=np.int32)
        open_ = [(self.cuts.get(length, 0), np.arange(len(counts)))]
        while open_:
            node, rows = open_.pop()
            if isinstance(node, int):
                out[rows] = node
            else:
                dim, at, under, over = node
                side = counts[rows, dim] <= at
                open_ += [(under, rows[side]), (over, rows[~side])]
        return out

    def cells_near(self, length: int, low: np.ndarray, high: np.ndarray, reach: int) -> list[int]:
        if length not in self.regions:
            return [0]
        lows, highs = self.regions[length]
        return np.flatnonzero(box_distance(lows, highs, low, high) <= reach).tolist()


def box_distance(lows: np.ndarray, highs: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of every row's box to the box (low, high)."""
    return (np.maximum(lows - high, 0) + np.maximum(low - highs, 0)).sum(axis=1, dtype=np.int32)


BLOCKS = "block bigint, length int, cell int, low binary, high binary, data binary, n binary"


def blocks(words: DataFrame, tree: UpperTree) -> DataFrame:
    """The words as blocks of one length and cell."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("word").to_pylist()
            length = np.array([len(w) for w in found], dtype=np.int32)
            cell = np.zeros(len(found), dtype=np.int32)
            for size in np.unique(length).tolist():
                at = np.flatnonzero(length == size)
                cell[at] = tree.cell_of(size, letter_counts(letters([found[i] for i in at.tolist()])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(length), pa.array(cell)], ["word", "n", "length", "cell"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, int]] = []
        place: tuple[int, int] | None = None

        def out() -> pa.RecordBatch:
            rows, uses = letters([w for w, _ in held]), np.array([n for _, n in held], dtype=np.int64)
            counts = letter_counts(rows)
            blobs = [counts.min(axis=0).tobytes(), counts.max(axis=0).tobytes(), rows.tobytes(), uses.tobytes()]
            return pa.RecordBatch.from_arrays(
                [pa.array([place[0]], pa.int32()), pa.array([place[1]], pa.int32()), *(pa.array([b], pa.binary()) for b in blobs)],
                ["length", "cell", "low", "high", "data", "n"],
            )

        for batch in batches:
            for word, n, length, cell in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "length", "cell"))):
                if held and (place != (length, cell) or len(held) >= BLOCK):
                    yield out()
                    held = []
                place = (length, cell)
                held.append((word, n))
        if held:
            yield out()

    dealt = words.select("word", "n").mapInArrow(deal, "word string, n bigint, length int, cell int")
    order = ["length", "cell", "word"]
    made = dealt.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, BLOCKS.split(", ", 1)[1])
    return made.select(F.monotonically_increasing_id().alias("block"), "*")


def meetings(index: DataFrame, tree: UpperTree) -> DataFrame:
    """(block, near): the blocks of equal and of next length whose boxes are in reach, each pair once."""
    boxes = index.select("block", "length", "cell", "low", "high")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for block, length, low, high in zip(*(batch.column(c).to_pylist() for c in ("block", "length", "low", "high"))):
                a, b = (np.frombuffer(x, np.int8).astype(np.int16) for x in (low, high))
                out += [(block, length, length, c) for c in tree.cells_near(length, a, b, 2)]
                out += [(block, length, length + 1, c) for c in tree.cells_near(length + 1, a, b, 1)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], ["from_block", "from_length", "length", "cell"])

    wanted = boxes.mapInArrow(look, "from_block bigint, from_length int, length int, cell int")
    met = wanted.join(boxes, ["length", "cell"]).filter((F.col("from_length") < F.col("length")) | (F.col("from_block") < F.col("block")))
    return met.groupBy(F.col("from_block").alias("block")).agg(F.collect_list(F.struct("block", "length", "low", "high")).alias("near"))


SENT = "to_block bigint, kind int, length int, data binary, n binary"


def send(index: DataFrame, met: DataFrame) -> DataFrame:
    """Every block's own words, and for the blocks near it those within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(to: int, kind: int, length: int, rows: np.ndarray, uses: np.ndarray) -> pa.RecordBatch:
            cells = [[to], [kind], [length], [rows.tobytes()], [uses.tobytes()]]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["to_block", "kind", "length", "data", "n"])

        for batch in batches:
            for block, length, data, n, near in zip(*(batch.column(c) for c in ("block", "length", "data", "n", "near"))):
                size = length.as_py()
                rows = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, size)
                uses = np.frombuffer(n.as_buffer(), np.int64)
                counts = letter_counts(rows)
                yield row(block.as_py(), 0, size, rows, uses)
                for other in near.as_py() or ():
                    low, high = (np.frombuffer(other[c], np.int8) for c in ("low", "high"))
                    some = np.flatnonzero(outside(counts, low, high) <= (2 if other["length"] == size else 1))
                    if len(some):
                        yield row(other["block"], 1, size, rows[some], uses[some])

    return index.select("block", "length", "data", "n").join(met, "block", "left").mapInArrow(run, SENT)


def outside(counts: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of every row to the box."""
    return (np.maximum(low - counts, 0) + np.maximum(counts - high, 0)).sum(axis=1, dtype=np.int32)


class BlockTree:
    """A k-d tree over the words of one block."""

    def __init__(self, rows: np.ndarray, uses: np.ndarray):
        self.rows, self.uses, self.length = rows, uses, rows.shape[1]
        counts = letter_counts(rows)
        self.counts, self.codes = counts, codes(counts)
        self.root = self._grow(np.arange(len(rows)))

    def _grow(self, at: np.ndarray) -> tuple:
        counts = self.counts[at]
        cut = halves(counts) if len(at) > LEAF else None
        low, high = counts.min(axis=0), counts.max(axis=0)
        if cut is None:
            return low, high, at, None, None
        side = counts[:, cut[0]] <= cut[1]
        return low, high, None, self._grow(at[side]), self._grow(at[~side])

    def partners(self, rows: np.ndarray, counts: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
        """(place among ``rows``, place in the block) of all words one edit apart."""
        reach = 2 if rows.shape[1] == self.length else 1
        sent, left, right = codes(counts), [], []
        open_ = [(self.root, np.arange(len(rows)))]
        while open_:
            (low, high, leaf, under, over), asked = open_.pop()
            asked = asked[outside(counts[asked], low, high) <= reach]
            if not len(asked):
                continue
            if leaf is None:
                open_ += [(under, asked), (over, asked)]
                continue
            step = max(1, TABLE // len(asked))
            for part in range(0, len(leaf), step):
                here = leaf[part : part + step]
                i, j = np.nonzero(np.bitwise_count(sent[asked][:, None] ^ self.codes[here]) <= reach)
                i, j = asked[i], here[j]
                if own:
                    i, j = i[i < j], j[i < j]
                same = one_edit(rows[i], self.rows[j])
                left.append(i[same])
                right.append(j[same])
        return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one letter replaced, or inserted in ``long``."""
    size = short.shape[1]
    if size == long.shape[1]:
        return (short != long).sum(axis=1) == 1
    ahead, behind = short != long[:, :size], short != long[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), size)
    last = np.where(behind.any(axis=1), size - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


def best_partners(rows: np.ndarray, at: np.ndarray, partners: np.ndarray, partner_uses: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """Per word with partners: how many, and the most frequent (the first of equal ones) with its count."""
    body = partners.tobytes().decode("latin-1")
    size = partners.shape[1]
    names = np.array([body[k * size : (k + 1) * size] for k in range(len(partners))], dtype=object)
    place = np.argsort(partners.view(f"S{size}").ravel(), kind="stable")  # letters' order is code-point order
    rank = np.empty(len(partners), np.int64)
    rank[place] = np.arange(len(partners))
    order = np.lexsort((rank, -partner_uses, at))
    found, first, n = np.unique(at[order], return_index=True, return_counts=True)
    best = order[first]
    own = rows[found].tobytes().decode("latin-1")
    width = rows.shape[1]
    return [own[k * width : (k + 1) * width] for k in range(len(found))], n, partner_uses[best], names[best].tolist()


def search(sent: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form): per block and word what was found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, block = None, None
        for batch in batches:
            for to, kind, length, data, n in zip(*(batch.column(c) for c in ("to_block", "kind", "length", "data", "n"))):
                rows = np.frombuffer(data.as_buffer(), np.uint8).reshape(-1, length.as_py())
                uses = np.frombuffer(n.as_buffer(), np.int64)
                if kind.as_py() == 0:
                    tree, block = BlockTree(rows, uses), to.as_py()
                assert block == to.as_py()
                i, j = tree.partners(rows, tree.counts if kind.as_py() == 0 else letter_counts(rows), kind.as_py() == 0)
                if len(i):
                    for args in ((rows, i, tree.rows[j], tree.uses[j]), (tree.rows, j, rows[i], uses[i])):
                        word, count, best, form = best_partners(*args)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(word, pa.string()), pa.array(count, pa.int64()), pa.array(best, pa.int64()), pa.array(form, pa.string())],
                            ["word", "n_near", "form_n", "form"],
                        )

    # a block's own words come first
    stream = sent.repartition("to_block").sortWithinPartitions("to_block", "kind")
    return stream.mapInArrow(run, "word string, n_near bigint, form_n bigint, form string")


def roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) from (word, form), following forms. Each is at least ten times as frequent as the word
    before, so a chain has no more links than ``most`` has digits, and doubling ends after a few joins."""
    links, steps = forms.select("word", F.col("form").alias("root")), 1
    while steps < len(str(most)):
        links = materialise(links, "spelling-roots")
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = links.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        steps *= 2
    return links


def spelling_variants(words: DataFrame) -> DataFrame:
    """``words``: (word, n), words distinct. Adds n_near, form, form_n and root."""
    words = materialise(words.select("word", "n"), "spelling-words")
    total = words.agg(F.count("*").alias("words"), F.max("n").alias("most")).first()
    dealt = F.pmod(F.xxhash64("word"), F.lit(max(1, total["words"]))) < SAMPLE  # about SAMPLE words reach the driver
    tree = UpperTree([r["word"] for r in words.filter(dealt).select("word").collect()], total["words"])
    index = materialise(blocks(words, tree), "spelling-blocks")
    found = search(send(index, meetings(index, tree)))
    best = F.min(F.struct((-F.col("form_n")).alias("rarity"), "form")).alias("best")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    out = words.join(near, "word", "left").withColumn("form_n", -F.col("best.rarity"))
    often = F.col("form_n") >= FORM_TIMES * F.col("n")
    out = out.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(often, F.col("best.form")).alias("form"), F.when(often, F.col("form_n")).alias("form_n")
    )
    out = materialise(out, "spelling-forms")
    chains = roots(out.filter(F.col("form").isNotNull()), total["most"] or 1)
    return out.join(chains, "word", "left").withColumn("root", F.coalesce("root", "word"))

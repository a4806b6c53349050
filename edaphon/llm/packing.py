"""Best-fit packing of token sequences by a configuration linear program.

Documents become token ids, long ones pieces. What is packed is the histogram of piece lengths, whose
size is set by the capacity and not by the corpus. The linear program over configurations (multisets
of lengths that fit a sequence) is solved by multiplicative weights: a length whose share has not been
served yet weighs more, a knapsack by dynamic programming finds the configurations of most weight, one
around every length, and each serves a fraction of its lengths, rounded up to whole uses. Rounds go on
until the program has placed every piece; the plan is the program's alone. Each place of a configuration
then takes a run of the ranks that pieces have within their length, so pieces find their sequence
without meeting each other.

Pieces of full length take a sequence each. Ranks are counted in salted parts of a length, so one
frequent length is not one task.

Defined cases: NULL text is empty text (one token, the end); an empty table gives no rows; rows that
repeat are packed as often as they occur; a NULL id stays NULL.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

CAPACITY = 2048
END = 0
#: Multiplicative weights: the part of a length that one use of a price serves at most, how fast the price
#: of a length falls as it is served, the part of the tokens a round must place to keep its allowance, and
#: the part by which the allowance grows.
STEP, RATE, PROGRESS, GROWTH = 0.1, 0.1, 0.01, 8
#: Powers of a length that its first price a token may have, tried in turn until a plan is as near to the
#: volume bound as `NEAR`; the shortest plan counts.
LONG, NEAR = (0.1, 1.0, 3.0), 0.002
#: Ranks of a length are counted in as many parts as there are partitions, from so many rows a part on.
PART_ROWS = 5_000
#: Bytes of units and ids a task remembers, units it learns at once, and characters it takes apart at once; they
#: bound its memory.
CACHE, LEARNED = 64_000_000, 20_000
CHUNK_CHARS = 4_000_000

#: A unit without white space but the newline in front.
PLAIN = "\\A\n?[^" + "".join(filter(str.isspace, map(chr, range(0x3001)))) + "]+\\z"
#: Marks that are taken off, and the characters before them: ASCII digits, and letters up to U+024F.
MARKS = '.,;:!?)"'
LETTERS = [c for c in map(chr, range(0x250)) if c in "0123456789" or c.isalpha()]

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"


class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    The byte-level vocabulary cuts a text before each space that follows a non-space, around a newline
    between non-spaces, and between a letter or digit and a punctuation mark. So texts are taken apart there,
    in columns: a unit is a word behind a space, or a newline with the word behind it; a mark at its end is
    taken off. Different units of a chunk are looked up once, what is new is encoded, and the ids go to all
    places in one gather. Texts with any other white space are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.newline = self.whole("\n")
        #: ids that open a unit: those that begin with a space, which only a word's first id does, and the newline
        self.opens = np.zeros(1 + max(self.tokenizer.get_vocab().values()), dtype=bool)
        self.opens[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True
        self.opens[np.frombuffer(self.newline, "<u4")] = True
        self.marks = pa.array([*map(self.whole, MARKS), b""], pa.large_binary())
        #: units, written without their space, and their ids; none: white space that units do not cover
        self.units, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def learn(self, units: pa.Array) -> pa.Array:
        """The ids of units that were not met before."""
        plain = pc.match_substring_regex(units, PLAIN)
        texts = pc.binary_join_element_wise(pc.if_else(pc.starts_with(units, "\n"), string(""), string(" ")), units, string("")).filter(plain)
        # what the library returns for a text is many times the text
        found = [self.learn_some(texts.slice(k, LEARNED).to_pylist()) for k in range(0, len(texts), LEARNED)]
        known = pa.concat_arrays([*found, self.marks.slice(len(MARKS))])
        plain = plain.to_numpy(zero_copy_only=False)
        return known.take(pa.array(np.where(plain, np.cumsum(plain) - 1, len(texts))))

    def learn_some(self, texts: list[str]) -> pa.Array:
        # one text for all, taken apart where a unit opens
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(texts)], add_special_tokens=False)[0].ids, dtype="<u4")
        at = np.append(4 * np.flatnonzero(self.opens[ids]), 4 * len(ids)).astype(np.int64)
        if len(at) == len(texts) + 1:
            return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at), pa.py_buffer(ids)])
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return pa.array([np.array(f.ids, dtype="<u4").tobytes() for f in found], pa.large_binary())

    def look_up(self, units: pa.Array) -> pa.Array:
        """The ids of different units."""
        last = pc.index_in(pc.utf8_slice_codeunits(units, -1), pa.array(list(MARKS), pa.large_string()))
        behind = pc.is_in(pc.utf8_slice_codeunits(units, -2, -1), pa.array(LETTERS, pa.large_string()))
        marked = pc.and_(last.is_valid(), behind)
        words = pc.if_else(marked, pc.utf8_slice_codeunits(units, 0, -1), units)
        before = len(self.units)
        # units met before are different and come first, so they keep their places
        coded = pa.concat_arrays([self.units, words]).dictionary_encode()
        self.ids = pa.concat_arrays([self.ids, self.learn(coded.dictionary.slice(before))])
        self.units, at = coded.dictionary, coded.indices.slice(before)
        found = self.ids.take(at)
        marks = self.marks.take(pc.if_else(pc.and_(marked, pc.greater(pc.binary_length(found), 0)), last, len(MARKS)))
        if self.units.nbytes + self.ids.nbytes > CACHE:  # what is in use stays
            kept = at.unique()
            self.units, self.ids = self.units.take(kept), self.ids.take(kept)
        return pc.binary_join_element_wise(found, marks, pa.scalar(b"", pa.large_binary()))

    def encode(self, texts: list[str]) -> list[bytes]:
        # a newline in front makes the first word a unit like others; its id is left out below
        lines = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        words = pc.split_pattern(pc.binary_join_element_wise(string("\n"), lines, string("")), " ")
        coded = words.values.dictionary_encode()
        ids = self.look_up(coded.dictionary).take(coded.indices)
        at, size = words.offsets.to_numpy(), pc.binary_length(ids).to_numpy()
        ends = np.concatenate([[0], np.cumsum(size)])
        gaps = np.concatenate([[0], np.cumsum(size == 0)])
        body = memoryview(ids.buffers()[2] or b"")
        starts, stops, covered = (ends[at[:-1]] + len(self.newline)).tolist(), ends[at[1:]].tolist(), (np.diff(gaps[at]) == 0).tolist()
        return [bytes(body[a:b]) if c else self.whole(text) for text, a, b, c in zip(texts, starts, stops, covered)]


def string(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``size`` tokens; only the first may be short."""
    head = size % capacity or capacity
    return [(0, head), *((at, capacity) for at in range(head, size, capacity))]


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece; ``with_ids`` adds the token ids themselves."""
    schema = PIECES + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, names = Encoder(tokenizer_path), ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int64())] * with_ids

        def packed(ids: list, texts: list[str]) -> pa.RecordBatch:
            rows: list[tuple] = []
            for doc_id, body in zip(ids, encoder.encode(texts)):
                body += END.to_bytes(4, "little")
                for k, (start, length) in enumerate(cut(len(body) // 4, capacity)):
                    part = body[4 * start : 4 * (start + length)]
                    row = (doc_id, k, start, length, zlib.crc32(part))
                    rows.append((*row, np.frombuffer(part, "<u4").astype("int64")) if with_ids else row)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            ids, texts, size = [], [], 0
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = body.as_py()
                ids.append(doc_id)
                texts.append(body)
                size += len(body)
                if size >= CHUNK_CHARS:
                    yield packed(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield packed(ids, texts)

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(run, schema)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Per capacity the most value that fits, and the index of a size taken there (-1: none, one token stays free)."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    upto = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if upto[c]:
            total = best[c - sizes[: upto[c]]] + values[: upto[c]]
            k = int(total.argmax())
            if total[k] > best[c]:
                best[c], pick[c] = total[k], k
    return best, pick


def configuration(first: int, values: np.ndarray, sizes: np.ndarray, left: np.ndarray, best: np.ndarray, pick: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration of most value with the size ``first`` in it, index -> how often; a size that has
    run out since the prices were set gives way to the best one left."""
    found, room = {first: 1}, capacity - int(sizes[first])
    while room > 0:
        k = int(pick[room])
        if k >= 0 and left[k] <= found.get(k, 0):
            fits = int(np.searchsorted(sizes, room, side="right"))
            total = np.where(left[:fits] > 0, best[room - sizes[:fits]] + values[:fits], -1.0)
            for gone in [i for i, n in found.items() if i < fits and n >= left[i]]:
                total[gone] = -1.0
            k = int(total.argmax()) if fits and total.max() > 0 else -1
            if k < 0:
                break
        if k < 0:
            room -= 1
        else:
            found[k] = found.get(k, 0) + 1
            room -= int(sizes[k])
    return found


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int, long: float = LONG[0], step: float = STEP, rate: float = RATE) -> list[tuple[tuple, int]]:
    """Whole uses of configurations (tuples of (index, times)) that serve all of ``counts``.

    Each round prices the lengths by the share of them that is left, fills one table, and takes from it the
    best configuration around every length, each for at most ``step`` of that length, rounded up to whole
    uses. A configuration that leaves more room than the round allows waits for other prices; the allowance
    grows when little was placed."""
    left, plan, allowed = counts.copy(), {}, 0
    while left.any():
        at = np.flatnonzero(left)
        some, own = sizes[at], left[at].copy()
        # a long piece is worth more a token than short ones, which fit in anywhere later
        values = some * (some / capacity) ** long * np.exp(rate * own / counts[at])
        best, pick = knapsack(values, some, capacity)
        placed, before = 0, int(some @ own)
        for k in range(len(some) - 1, -1, -1):
            if not own[k]:
                continue
            found = configuration(k, values, some, own, best, pick, capacity)
            room = capacity - sum(int(some[i]) * n for i, n in found.items())
            if room > allowed:
                continue
            often = int(min(max(1, -(-int(counts[at[k]]) * step // 1)), *(own[i] // n for i, n in found.items())))
            if often:
                key = tuple(sorted((int(at[i]), n) for i, n in found.items()))
                plan[key] = plan.get(key, 0) + often
                for i, n in found.items():
                    own[i] -= often * n
                placed += often * (capacity - room)
        left[at] = own
        if placed < PROGRESS * before:
            allowed = min(capacity, allowed + 1 + allowed // GROWTH)
    return list(plan.items())


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[str, np.ndarray], int]:
    """Places (length, first rank, uses, first sequence, offset) and the number of sequences."""
    lengths = sorted(size for size in histogram if size < capacity)
    sizes, counts = np.array(lengths, dtype=np.int64), np.array([histogram[x] for x in lengths], dtype=np.int64)
    plan: list[tuple[tuple, int]] = []
    for long in LONG if lengths else ():
        found = configurations(sizes, counts, capacity, long)
        plan = min(plan or found, found, key=lambda groups: sum(often for _, often in groups))
        if sum(often for _, often in plan) <= (1 + NEAR) * float(sizes @ counts) / capacity:
            break
    places, used, sequences = [], dict.fromkeys(range(len(sizes)), 0), 0
    for key, often in plan:
        offset = 0
        for k, n in key:
            for _ in range(n):
                places.append((int(sizes[k]), used[k], often, sequences, offset))
                used[k] += often
                offset += int(sizes[k])
        sequences += often
    names = ("length", "rank", "uses", "sequence", "offset")
    table = np.array(sorted(places), dtype=np.int64).reshape(-1, len(names))
    return {name: table[:, i] for i, name in enumerate(names)}, sequences


def with_length_rank(pieces: DataFrame, rows: int) -> DataFrame:
    """Adds ``rank`` within ``length``, counted in parts and shifted by the parts before."""
    usual = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(usual, -(-rows // PART_ROWS)))
    salted = pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = F.sum("_n").over(W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shift = salted.groupBy("length", "_part").agg(F.count("*").alias("_n")).withColumn("_shift", F.coalesce(before, F.lit(0))).drop("_n")
    place = F.row_number().over(W.partitionBy("length", "_part").orderBy("doc_id", "piece", "ids_crc32")) - 1
    return salted.withColumn("rank", place).join(shift, ["length", "_part"]).withColumn("rank", F.col("rank") + F.col("_shift")).drop("_part", "_shift")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns with ``length``, ``doc_id``, ``piece``, ``ids_crc32``) with
    ``sequence_id`` and ``offset``."""
    pieces = materialise(pieces, "pack-pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places, sequences = solve(histogram, capacity)
    rows = sum(n for size, n in histogram.items() if size < capacity)
    full = pieces.filter(F.col("length") == capacity).withColumns(
        {"sequence_id": F.monotonically_increasing_id() + sequences, "offset": F.lit(0).cast("long")}
    )
    short = with_length_rank(pieces.filter(F.col("length") < capacity), rows)
    columns = pieces.columns
    shape = 1 << 44

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = places["length"] * shape + places["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(keys, length * shape + rank, side="right") - 1
            sequence = places["sequence"][at] + rank - places["rank"][at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(sequence), pa.array(places["offset"][at])],
                [*columns, "sequence_id", "offset"],
            )

    placed = short.select(*columns, "rank").mapInArrow(place, full.schema)
    return full.unionByName(placed)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **options) -> DataFrame:
    return pack(tokenized_pieces(docs, tokenizer_path, capacity, **options), capacity)


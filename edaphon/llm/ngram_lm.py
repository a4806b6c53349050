"""Interpolated modified Kneser-Ney language model over word pairs.

Counting is Spark's: words, then pairs, counted per chunk of text first and dealt by context. A
context that holds more than a thousandth of all tokens is dealt by pair instead (at most a thousand
such contexts exist), so no frequent word is one task. Words become sorted arrays of 64-bit hashes; a
word's place in them is its number, and a pair's key is its two numbers in 64 bits, sorted likewise
(so at most 2^32 - 2 different words; more are an error). Arrays lie in the shared folder, written
under a name of their own and renamed, so a task may run twice. Scoring tasks map the arrays into memory and look up their sorted keys; what a
task holds is its chunk, whatever the model's size.

For a pair ``u w`` with count c, discounts D by count (1, 2, 3 or more):
``p(w | u) = max(c - D(c), 0) / c(u) + g(u) * p(w)``, ``g(u)`` being the discounted mass of ``u``;
``p(w)`` is the same on the number of different contexts of ``w``, with the rest spread evenly over all
known words and one unknown. A document begins after a start mark, which is a context only, and ends
with an end token, which is counted. An unseen context leaves ``p(w)``.

Defined cases: NULL and empty texts are the end token alone; a NULL id is in training; rows that repeat
count as often as they occur; with no training documents every known count is 0 and the model is even.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import fresh_path, settled

# The fold that is held out.
FOLDS, HELD_OUT = 7, 2
HOT_SHARE = 1000
SHARD_PAIRS = 1_000_000
CHUNK_BYTES = 3_000_000
END = 2
#: Numbers of words that are not in the model.
UNKNOWN = -1
MIX_A, MIX_B, MIX_C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit hash for a pair of hashes."""
    x = a * MIX_A + (b ^ (b >> np.uint64(29)))
    x = (x ^ (x >> np.uint64(30))) * MIX_B
    x = (x ^ (x >> np.uint64(27))) * MIX_C
    return x ^ (x >> np.uint64(31))


def hashed_tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of all texts, each text with its end token; tokens per text."""
    import xxhash

    found = [(t or "").encode().lower().split() for t in texts]
    sizes = np.array([len(w) + 1 for w in found], dtype=np.int64)
    words = pa.array([w for ws in found for w in ws], pa.large_binary()).dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in words.dictionary.to_pylist()], dtype=np.uint64)
    out = np.full(int(sizes.sum()), END, dtype=np.uint64)
    body = np.ones(len(out), dtype=bool)
    body[np.cumsum(sizes) - 1] = False
    if len(known):
        out[body] = known[words.indices.to_numpy()]
    return out, sizes


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches of about ``CHUNK_BYTES`` of text; the text is the last column."""
    for batch in batches:
        texts, start, size = batch.column(batch.num_columns - 1), 0, 0
        held: list[str | None] = []
        for i in range(batch.num_rows):
            held.append(texts[i].as_py())
            size += len(held[-1] or "")
            if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                yield batch.slice(start, i + 1 - start), held
                held, start, size = [], i + 1, 0


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(keys) else counts


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)


class Folder:
    """Files of arrays in the shared folder: written whole, mapped into memory."""

    def __init__(self, uri: str):
        self.uri = uri

    def local(self) -> str | None:
        scheme, found, path = self.uri.partition("://")
        return self.uri if not found else path if scheme == "file" else self.uri[5:] if self.uri.startswith("file:") else None

    def write(self, name: str, array: np.ndarray) -> None:
        if (top := self.local()) is not None:
            os.makedirs(top, exist_ok=True)
            array.tofile(part := f"{top}/.{name}-{uuid.uuid4().hex}")
            os.replace(part, f"{top}/{name}")
            return
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.uri)
        store.create_dir(top, recursive=True)
        with store.open_output_stream(part := f"{top}/{name}-{uuid.uuid4().hex}") as out:
            out.write(array.tobytes())
        store.move(part, f"{top}/{name}")

    def map(self, name: str, kind: np.dtype | type) -> np.ndarray:
        """An empty array where no such file was written."""
        if (top := self.local()) is not None:
            path = f"{top}/{name}"
            there = os.path.exists(path) and os.path.getsize(path)
            return np.memmap(path, dtype=kind, mode="r") if there else np.zeros(0, kind)
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(self.uri)
        if not store.get_file_info(f"{top}/{name}").size:
            return np.zeros(0, kind)
        with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{top}/{name}") as data:
            while block := data.read(1 << 24):
                copy.write(block)
            copy.flush()
            return np.memmap(copy, dtype=kind, mode="r")  # the file has no name, so nothing stays behind


def look_up(folder: Folder, kind: str, shards: int, keys: np.ndarray, shard: np.ndarray, columns: dict[str, type]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of ``keys`` in the sorted arrays of their shards (-1: missing), and the values beside them (0)."""
    place, out = np.full(len(keys), -1, dtype=np.int64), [np.zeros(len(keys), dtype=np.float64) for _ in columns]
    order = np.lexsort((keys, shard))
    edges = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(edges)).tolist():
        rows = order[edges[s] : edges[s + 1]]
        held = folder.map(f"{kind}-{s}-key", np.uint64)
        if not len(held):
            continue
        at = np.minimum(np.searchsorted(held, keys[rows]), len(held) - 1)
        hit = held[at] == keys[rows]
        rows, at = rows[hit], at[hit]
        place[rows] = at
        for values, (column, type_) in zip(out, columns.items()):
            values[rows] = folder.map(f"{kind}-{s}-{column}", type_)[at]
    return place, out


@dataclass
class Words:
    """Where the words lie: their first numbers by shard, and how many there are."""

    folder: str
    first: np.ndarray
    vocabulary: int

    @property
    def shards(self) -> int:
        return len(self.first)

    def numbers(self, hashes: np.ndarray, columns: dict[str, type]) -> tuple[np.ndarray, list[np.ndarray]]:
        shard = word_shard(hashes, self.shards).astype(np.int64)
        place, values = look_up(Folder(self.folder), "word", self.shards, hashes, shard, columns)
        return np.where(place < 0, UNKNOWN, place + self.first[shard]), values


@dataclass
class Model:
    """Where the arrays lie, and the few numbers that are not in them. ``hot``: per context number its total and
    its numbers of successors seen once, twice, more often."""

    words: Words
    pair_shards: int
    tokens: int
    pairs: int
    word_discounts: tuple[float, float, float]
    pair_discounts: tuple[float, float, float]
    word_mass: float
    hot: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D for counts 1, 2, 3 or more from the numbers of items that occur 1 to 4 times; half the count where
    these are too few to give one between nothing and the count."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    found = [k + 1 - (k + 2) * y * n[k + 1] / n[k] if n[k] else 0.0 for k in range(3)]
    return tuple(d if 0 < d < k + 1 else (k + 1) / 2 for k, d in enumerate(found))  # type: ignore[return-value]


def discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)], 0.0)


def count_words(docs: DataFrame) -> DataFrame:
    """(key, n): training tokens by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            keys, n = np.unique(hashed_tokens(texts)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([signed(keys), pa.array(n.astype(np.int64))], ["key", "n"])

    return docs.mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(20)) % np.uint64(shards)


def write_words(counts: DataFrame, folder: str, shards: int) -> Words:
    """Writes the words (key, n) as sorted arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(unsigned(b.column(1)), b.column(2).to_numpy()) for b in batches]
        if not held:
            return
        key, n = (np.concatenate(x) for x in zip(*held))
        shard = word_shard(key, shards)
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            mine = mine[np.argsort(key[mine])]
            Folder(folder).write(f"word-{s}-key", key[mine])
            Folder(folder).write(f"word-{s}-n", n[mine])
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([len(mine)], pa.int64())], ["shard", "n"])

    shard = F.pmod(F.shiftrightunsigned("key", 20), F.lit(shards)).cast("int").alias("shard")
    sizes = counts.select(shard, "key", "n").repartition(shards, "shard").mapInArrow(run, "shard bigint, n bigint").collect()
    size = np.zeros(shards, dtype=np.int64)
    for row in sizes:
        size[row["shard"]] = row["n"]
    return Words(folder, np.cumsum(size) - size, int(size.sum()))


def pair_shard(context: np.ndarray, pair: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """A pair's shard: its context's, or its own if the context is hot (``hot`` ascends)."""
    at = np.minimum(np.searchsorted(hot, context), max(len(hot) - 1, 0))
    is_hot = hot[at] == context if len(hot) else np.zeros(len(context), dtype=bool)
    by = np.where(is_hot, pair, context.astype(np.uint64))
    return ((mixed(by, by) >> np.uint64(20)) % np.uint64(shards)).astype(np.int64)


def with_contexts(numbers: np.ndarray, sizes: np.ndarray, start: int) -> np.ndarray:
    """The word before each one; the start mark before the first of a text."""
    before = np.r_[start, numbers[:-1]]
    before[np.cumsum(sizes) - sizes] = start
    return before


def pair_keys(context: np.ndarray, words: np.ndarray) -> np.ndarray:
    return (context.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64)


def counted_pairs(docs: DataFrame, words: Words, hot: np.ndarray, shards: int) -> DataFrame:
    """(shard, key, n): pairs of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in chunks(batches):
            tokens, sizes = hashed_tokens(texts)
            each, back = np.unique(tokens, return_inverse=True)
            numbers = words.numbers(each, {})[0][back]
            keys, n = np.unique(pair_keys(with_contexts(numbers, sizes, words.vocabulary), numbers), return_counts=True)
            shard = pair_shard((keys >> np.uint64(32)).astype(np.int64), keys, hot, shards)
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), signed(keys), pa.array(n.astype(np.int32))], ["shard", "key", "n"])

    return docs.mapInArrow(run, "shard int, key bigint, n int")


#: Kinds of rows that the pair arrays leave behind: contexts of a word; figures of a hot context; how many pairs occur
#: 1 to 4 times.
OF_WORD, OF_HOT, OF_TIMES = 0, 1, 5
CONTEXT_COLUMNS = {"c0": np.int64, "c1": np.int32, "c2": np.int32, "c3": np.int32}


def write_pairs(pairs: DataFrame, folder: str, hot: np.ndarray, shards: int) -> DataFrame:
    """Writes the sorted arrays of pairs and contexts; returns (kind, key, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(unsigned(b.column(1)), b.column(2).to_numpy()) for b in batches]
        if not held:
            return
        key, n = (np.concatenate(x) for x in zip(*held))
        del held
        key, n = summed(key, n.astype(np.int64))
        context, word = (key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out: list[tuple[int, np.ndarray, np.ndarray]] = [(OF_WORD, *np.unique(word, return_counts=True))]
        times = np.bincount(np.minimum(n, 5), minlength=6)
        out += [(OF_TIMES + j, np.array([j]), times[j + 1 : j + 2]) for j in range(4)]
        del word
        shard, store = pair_shard(context, key, hot, shards), Folder(folder)
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            store.write(f"pair-{s}-key", key[mine])
            store.write(f"pair-{s}-n", n[mine].astype(np.uint32))
            c, k = context[mine], n[mine]
            first = np.flatnonzero(np.r_[True, np.diff(c) != 0])
            is_hot = np.isin(c[first], hot)
            store.write(f"context-{s}-key", c[first][~is_hot].astype(np.uint64))
            for j, (column, type_) in enumerate(CONTEXT_COLUMNS.items()):
                x = np.add.reduceat((k, k == 1, k == 2, k >= 3)[j].astype(np.int64), first)
                store.write(f"context-{s}-{column}", x[~is_hot].astype(type_))
                out.append((OF_HOT + j, c[first][is_hot], x[is_hot]))
        for kind, keys, values in out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(values.astype(np.int64))], ["kind", "key", "n"]
            )

    return pairs.repartition(shards, "shard").mapInArrow(run, "kind int, key bigint, n bigint")


def write_contexts(counts: DataFrame, words: Words) -> DataFrame:
    """Writes the numbers of contexts (key: word number, n) beside the words. Returns a row per shard."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = np.searchsorted(words.first, batch.column(0).to_numpy(), side="right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *batch.columns], ["shard", "key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in b.columns] for b in batches]
        if not held:
            return
        shard, key, n = (np.concatenate(x) for x in zip(*held))
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            a = np.zeros(len(Folder(words.folder).map(f"word-{s}-key", np.uint64)), dtype=np.int64)
            a[key[mine] - words.first[s]] = n[mine]
            Folder(words.folder).write(f"word-{s}-a", a)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64())], ["shard"])

    rows = counts.select("key", "n").mapInArrow(dealt, "shard int, key bigint, n bigint")
    return rows.repartition(words.shards, "shard").mapInArrow(run, "shard bigint")


def train(docs: DataFrame, text: str = "text") -> Model:
    """A model of all ``docs``."""
    rows, spark = docs.select(F.col(text).cast("string").alias("text")), docs.sparkSession
    folder = fresh_path(spark, "lm")
    counts = settled(count_words(rows), "lm-words")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("v")).first()
    tokens, vocabulary = size["tokens"], size["v"]
    if vocabulary >= 2**32 - 1:
        raise ValueError("a model has room for 2^32 - 2 different words")
    words = write_words(counts, folder, max(1, -(-vocabulary // SHARD_PAIRS)))
    # at most HOT_SHARE words, and the start mark, which every document has
    often = counts.filter(F.col("n") * HOT_SHARE >= tokens).select("key").collect()
    hashes = np.array(sorted(r["key"] % 2**64 for r in often), dtype=np.uint64)
    hot = np.sort(np.r_[words.numbers(hashes, {})[0], vocabulary])
    shards = max(1, -(-tokens // SHARD_PAIRS))
    told = settled(write_pairs(counted_pairs(rows, words, hot, shards), folder, hot, shards), "lm-pairs")
    contexts = settled(told.filter(F.col("kind") == OF_WORD).groupBy("key").agg(F.sum("n").alias("n")), "lm-contexts")
    write_contexts(contexts, words).count()
    # some thousands of rows at most
    few = {(r["kind"], r["key"]): r["n"] for r in told.filter(F.col("kind") != OF_WORD).groupBy("kind", "key").agg(F.sum("n").alias("n")).collect()}
    times = contexts.agg(
        *[F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in range(1, 5)],
        F.count(F.when(F.col("n") > 2, 1)).alias("more"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"),
    ).first()
    d = discounts([times[f"n{k}"] for k in range(1, 5)])
    mass = (d[0] * times["n1"] + d[1] * times["n2"] + d[2] * times["more"]) / times["pairs"] if times["pairs"] else 1.0
    return Model(
        words, shards, tokens, times["pairs"], d, discounts([few.get((OF_TIMES + j, j), 0) for j in range(4)]), mass,
        {int(h): tuple(few.get((OF_HOT + j, int(h)), 0) for j in range(4)) for h in hot},
    )


def word_probabilities(model: Model, contexts: np.ndarray) -> np.ndarray:
    """p(w) from the numbers of contexts."""
    even = model.word_mass / (model.words.vocabulary + 1)
    return (discounted(contexts, model.word_discounts) / model.pairs if model.pairs else 0.0) + even


def pair_probabilities(model: Model, context: np.ndarray, words: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """p(w | u) from the arrays of pairs and contexts and p(w)."""
    folder, hot = Folder(model.words.folder), np.array(sorted(model.hot), dtype=np.int64)
    # each pair once
    known = np.flatnonzero((context != UNKNOWN) & (words != UNKNOWN))
    keys, again = np.unique(pair_keys(context[known], words[known]), return_inverse=True)
    shard = pair_shard((keys >> np.uint64(32)).astype(np.int64), keys, hot, model.pair_shards)
    n = np.zeros(len(words))
    n[known] = look_up(folder, "pair", model.pair_shards, keys, shard, {"n": np.uint32})[1][0][again]
    # each context once
    each, back = np.unique(context, return_inverse=True)
    bare = np.maximum(each, 0).astype(np.uint64)
    shard = pair_shard(each, bare, np.zeros(0, np.int64), model.pair_shards)
    found = look_up(folder, "context", model.pair_shards, bare, shard, CONTEXT_COLUMNS)[1]
    for h in np.flatnonzero(np.isin(each, hot)).tolist():
        for values, value in zip(found, model.hot[int(each[h])]):
            values[h] = value
    total, *by_count = found
    total[each == UNKNOWN] = 0
    seen = total > 0
    mass = sum(d * x for d, x in zip(model.pair_discounts, by_count))
    share = np.divide(mass, total, out=np.ones(len(total)), where=seen)
    top = np.divide(discounted(n, model.pair_discounts), total[back], out=np.zeros(len(n)), where=seen[back])
    return top + share[back] * lower


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_tokens, n_known, base_score (add-one words) and score, the log10 probability."""
    schema = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    rest = log10(model.tokens + model.words.vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in chunks(batches):
            tokens, sizes = hashed_tokens(texts)
            each, back = np.unique(tokens, return_inverse=True)
            numbers, (n, a) = model.words.numbers(each, {"n": np.int64, "a": np.int64})
            words = numbers[back]
            p = pair_probabilities(model, with_contexts(words, sizes, model.words.vocabulary), words, word_probabilities(model, a)[back])
            first = np.cumsum(sizes) - sizes
            totals = [np.add.reduceat(x, first) for x in ((n > 0).astype(np.int64)[back], np.log10(n + 1.0)[back] - rest, np.log10(p))]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(sizes), *map(pa.array, totals)], ["doc_id", "n_tokens", "n_known", "base_score", "score"]
            )

    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)

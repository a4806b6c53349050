"""SimHash near-duplicates through deletion-variant signatures.

A 64-bit fingerprint is cut into two segments. Of two fingerprints at most two bits apart, one segment
differs by at most one bit, so both segments are indexed under their 32 variants with one bit blanked
out (key: segment, blanked bit, remaining bits). Fingerprints that share a key meet in an equality
group and are verified by their distance. A group puts out a spanning forest of its links and not its
pairs; groups beyond ``GROUP`` are dealt again by equal thirds of the other segment (at most two
differing bits leave one third equal), which is exact. Links end in connected components.

Documents with one fingerprint are one node from the start, so copies never meet in pairs.

Defined cases: NULL, empty and wordless texts have fingerprint zero and link like any other; fewer
words than a shingle give one shingle of all words; a NULL id has a fingerprint and the component of
its fingerprint, which is NULL if no document in it has an id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import materialise
from edaphon.llm.graph import components

# The fingerprint.
SEED = 42
SHINGLE = 3
MAX_BITS = 2

SEGMENT = 32
THIRDS = ((0, 11), (11, 11), (22, 10))
GROUP = 4096
BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits set in more than half of the shingles' hashes."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    body, digest, seed = b" ".join(found), xxhash.xxh64_intdigest, SEED
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in found)]
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(shingle, len(found))
    spans = list(zip(starts, ends[width - 1 :]))
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(spans), BLOCK):
        hashes = np.array([digest(body[a:b], seed) for a, b in spans[at : at + BLOCK]], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(spans), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id and ``bits``, the fingerprint as a signed 64-bit integer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "bits"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, bits bigint")


def wildcard_keys(prints: DataFrame) -> DataFrame:
    """(key, bits): both segments under each of their one-bit blanks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank = ~(np.uint64(1) << np.arange(SEGMENT, dtype=np.uint64))
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for segment in range(2):
                part = (bits >> np.uint64(SEGMENT * segment)) & np.uint64(0xFFFFFFFF)
                place = (np.arange(SEGMENT, dtype=np.uint64) + np.uint64(SEGMENT * segment)) << np.uint64(SEGMENT)
                keys = (part[:, None] & blank) | place
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(bits, SEGMENT).view(np.int64))], ["key", "bits"]
                )

    return prints.select("bits").mapInArrow(run, "key bigint, bits bigint")


def forest(bits: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that hold together what lies at most ``most`` bits apart within a group."""
    root, links = list(range(len(bits))), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(1, len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits[:i] ^ bits[i]) <= most).tolist():
            a, b = find(i), find(j)
            if a != b:
                root[a] = b
                links.append((int(bits[i]), int(bits[j])))
    return links


def verified(keyed: DataFrame, most: int, split: bool) -> DataFrame:
    """Groups of equal ``key`` to rows (key NULL, u, v) for links; with ``split``, members of groups
    beyond ``GROUP`` come out as (new key, u, NULL)."""
    dealt = keyed.repartition("key").sortWithinPartitions("key", "bits")

    def again(key: int, bits: np.ndarray) -> list[tuple[int, int, None]]:
        segment = 1 - ((key >> SEGMENT) & 0xFFFFFFFF) // SEGMENT
        part = (bits >> np.uint64(SEGMENT * segment)) & np.uint64(0xFFFFFFFF)
        rows = []
        for k, (at, width) in enumerate(THIRDS):
            value = (part >> np.uint64(at)) & np.uint64((1 << width) - 1)
            for v, b in zip(value.tolist(), bits.view(np.int64).tolist()):
                rows.append((hash((key, k, v)), b, None))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) if out else [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["key", "u", "v"])

        def closed(key: int, bits: np.ndarray, large: bool) -> list[tuple]:
            if large or (split and len(bits) > GROUP):
                return again(key, np.unique(bits))
            bits = np.unique(bits)
            signed = [(int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))) for a, b in forest(bits, most)] if len(bits) > 1 else []
            return [(None, a, b) for a, b in signed]

        held_key, held, large = None, np.zeros(0, np.uint64), False
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            bits = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(keys):
                continue
            edges = np.flatnonzero(np.diff(keys)) + 1
            starts, ends, out = [0, *edges.tolist()], [*edges.tolist(), len(keys)], []
            # groups that lie inside the batch and have one member need nothing
            for a, b in ((a, b) for a, b in zip(starts, ends) if b - a > 1 or a == 0 or b == len(keys)):
                key = int(keys[a])
                if key != held_key:
                    if held_key is not None:
                        out += closed(held_key, held, large)
                    held_key, held, large = key, bits[a:b], False
                else:
                    held = np.concatenate([held, bits[a:b]])
                if split and len(held) > GROUP:
                    out += again(key, np.unique(held))
                    held, large = held[:0], True
            yield rows_of(out)
        if held_key is not None:
            yield rows_of(closed(held_key, held, large))

    return dealt.mapInArrow(run, "key bigint, u bigint, v bigint")


def links(prints: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Links (u, v) between distinct fingerprints that lead to the same components as all of them."""
    if most > 2:
        raise ValueError("two segments with one blank each cover at most two differing bits")
    first = materialise(verified(wildcard_keys(prints), most, split=True), "simhash-groups")
    second = verified(first.filter("key is not null").select("key", F.col("u").alias("bits")), most, split=False)
    return first.filter("key is null").select("u", "v").union(second.select("u", "v"))


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable by links."""
    rows = materialise(fingerprints(docs, id, text, shingle), "simhash-prints")
    prints = materialise(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(links(prints, most))
    nodes = prints.join(roots, prints["bits"] == roots["node"], "left").select("bits", "least", F.coalesce("root", "bits").alias("root"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    answer = nodes.join(least, "root").select(F.col("bits").alias("_bits"), "component_id")
    return rows.join(answer, F.col("bits") == F.col("_bits")).select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )

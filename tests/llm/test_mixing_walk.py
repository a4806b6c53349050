"""The walk along the order against plain Python, with documents that do not fit in its way."""

import pytest
from pyspark.sql import functions as F

from edaphon.llm import mixing

WEIGHTS = (2, 8)


def long_rows():
    """Sources of 2,000 short documents and five that are longer than the gap when the order meets them."""
    for k in range(24):
        for i in range(2005):
            yield k * 10_000 + i, f"s{k:02d}", 100 if i < 2000 else 80_000


def mixed_rows():
    """Many sizes, empty documents, repeated rows, a NULL id and a NULL source."""
    for i in range(3000):
        yield i, None if i % 3 == 0 else f"s{i % 3}", i * i % 997 if i % 11 else 40_000
    yield from [(7, "s1", 49)] * 90 + [(None, "s1", 13)] * 3 + [(None, "s2", 0)]


def walked(rows, left):
    """Keys taken along the order, and the words still missing after them."""
    units = {}
    for r in rows:
        if r.room and r.size > 0:
            key = (r.rank, r.id is not None, r.id or 0, r.size)
            units[key] = units.get(key, 0) + r.size
    taken = set()
    for key in sorted(units):
        if units[key] <= left:
            left -= units[key]
            taken.add(key)
    over = [(words, key) for key, words in units.items() if key not in taken and left < words < 2 * left]
    if over:
        left -= min(over)[0]
        taken.add(min(over)[1])
    return taken, left, min((words for key, words in units.items() if key not in taken), default=None)


@pytest.mark.parametrize("make", [long_rows, mixed_rows])
@pytest.mark.parametrize("fill", [mixing.FILL, 1])
def test_walk(spark, make, fill, monkeypatch):
    monkeypatch.setattr(mixing, "FILL", fill)
    docs = spark.createDataFrame(list(make()), "doc_id long, source string, size long")
    plan, sizes = mixing.mixing_plan(docs, F.col("size"), mixing.short_first(F.col("size")), weights=WEIGHTS)
    ranked = mixing.with_rank(mixing.with_plan(sizes, plan.select("source", "level", "target")), mixing.MAX_COPIES, 1)
    by_source, got = {}, {}
    for r in ranked.collect():
        by_source.setdefault(r.source, []).append(r)
    for r in mixing.copies(sizes, plan).collect():
        got.setdefault(r.source, []).append((r.id is not None, r.id or 0, r.size, r.copies))
    for source, rows in by_source.items():
        certain = sum(r.certain * r.size for r in rows)
        taken, left, smallest = walked(rows, max(0.0, rows[0].target - certain))
        want = [
            (r.id is not None, r.id or 0, r.size, r.certain + ((r.rank, r.id is not None, r.id or 0, r.size) in taken)) for r in rows
        ]
        assert sorted(got[source]) == sorted(want)
        words = sum(size * n for _, _, size, n in got[source])
        if smallest is not None:
            assert abs(rows[0].target - words) <= smallest / 2 + 1e-6

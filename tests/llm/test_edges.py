"""Empty tables, repeated rows, NULL ids, extra columns with clashing names, and parts on their own."""

import random

import brute
import numpy as np
import pytest
from odd_tables import SCHEMA, odd_rows, write
from pyspark.sql import functions as F

import corpus_pipeline
from edaphon.llm import licenses, packing, personal_data, quality_rules, topk
from edaphon.llm.base import word_count
from edaphon.llm.graph import components
from edaphon.llm.line_dedup import remove_repeated_lines
from edaphon.llm.mixing import mixed_documents, source_targets
from edaphon.llm.queries import QUERIES, tokenizer_path
from edaphon.llm.simhash import near_duplicates
from edaphon.llm.substring_dedup import remove_repeats
from edaphon.llm.topk import integer_vectors, top_k


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_empty_pipeline(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.fixture(scope="module")
def repeated(spark, tmp_path_factory):
    """Every document twice, some without an id, and columns named like results."""
    rows = [(None if r[0] % 11 == 3 else r[0], *r[1:], -1, "x", "y", 7.0) for r in odd_rows()]
    return write(spark, tmp_path_factory.mktemp("repeated"), rows * 2, f"{SCHEMA}, n_words long, kept string, fingerprint string, size double")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op4_exact_top_k", "op11_centroid_clusters", "op12_spelling_variants"}))
def test_repeated_rows_get_equal_answers(spark, repeated, name):
    frame = QUERIES[name](spark, repeated)
    assert len(set(frame.columns)) == len(frame.columns)
    rows = frame.collect()
    if name == "op8_best_fit_packing":
        assert sum(r["piece"] == 0 for r in rows) == 2 * len(odd_rows())
        return
    assert len(rows) == 2 * len(odd_rows())
    by_id = {}
    for row in rows:
        if row["doc_id"] is not None:
            assert by_id.setdefault(row["doc_id"], row) == row


def test_pipeline_with_awkward_rows(spark, repeated):
    docs = spark.read.parquet(f"{repeated}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settled(stage(spark, docs, repeated), "test")
        assert docs.columns == columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, repeated).count() > 0


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 5)], "doc_id long, text string, source string, n_words long")
    assert remove_repeats(docs).columns == ["doc_id", "text", "source", "n_words", "n_removed", "kept_text"]
    assert remove_repeated_lines(docs).columns == [*docs.columns, "n_lines", "n_equal", "n_near", "kept_text"]
    assert quality_rules.apply_rules(docs).first()["n_words"] == 3
    assert mixed_documents(docs, word_count(F.col("text"))).columns == docs.columns


def test_rows_without_an_id_are_the_earliest(spark):
    passage = " ".join(f"w{k}" for k in range(25))
    docs = spark.createDataFrame([(None, passage), (-5, passage)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in remove_repeats(docs).collect()} == {None: 0, -5: 25}
    assert {r["doc_id"]: r["n_equal"] for r in remove_repeated_lines(docs).collect()} == {None: 0, -5: 1}


def test_documents_without_an_id_in_simhash(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "q r s t"), (9, None), (8, "")], "doc_id long, text string")
    rows = near_duplicates(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in rows) == [
        ("4", "4"), ("8", "8"), ("9", "8"), ("None", "4"), ("None", "None"),
    ]


def test_components(spark):
    rng = np.random.default_rng(3)
    chain = [(k, k + 1) for k in range(1, 60)]
    star = [(100, 100 + k) for k in range(1, 50)]
    loose = [(int(a), int(b)) for a, b in rng.integers(1000, 1100, (70, 2))]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star + loose, "u long, v long")).collect()}
    assert all(got[k] == 1 for k in range(1, 61)) and all(got[100 + k] == 100 for k in range(50))
    for a, b in loose:
        assert a == b or got[a] == got[b]
    assert all(got[root] == root for root in got.values())


def test_bad_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, [0.5]), (1, [0.5, 0.5]), (8, [0.5, 0.5])]
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in top_k(vectors, F.col("vec_id") % 100 == 0, 3).orderBy("query_id", "rank").collect()]
    half = 512 * 1024
    assert got == [(0, 1, 1, half), (0, 2, 7, half), (0, 3, 8, half), (100, 1, 1, half), (100, 2, 8, half), (100, 3, 0, 0)]


def test_large_components_stay_exact(spark):
    rows = [(0, [3.0e9, 1.0]), (1, [1.0e9, 2.0]), (2, [1.0e9, 1.0])]
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1)
    got = [(r["vec_id"], r["score"]) for r in top_k(vectors, F.col("vec_id") == 0, 2).orderBy("rank").collect()]
    assert got == [(1, 3 * 10**18 + 2), (2, 3 * 10**18 + 1)]


def test_scores_beyond_a_bigint_are_its_ends(spark):
    rows = [(0, [1e12, 1.0]), (3, [1e12, 0.0]), (2, [2e12, 0.0]), (1, [-1e12, 5.0]), (4, [0.0, 7.0]), (5, [1e300, 0.0]), (6, [-1e300, 0.0])]
    vectors = integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r["vec_id"], r["score"]) for r in top_k(vectors, F.col("vec_id") == 0, 10).orderBy("rank").collect()]
    high, low = 2**63 - 1, -(2**63)
    assert got == [(2, high), (3, high), (5, high), (4, 7 * 1024**2), (1, low), (6, low)]


@pytest.mark.parametrize("size", [1, 1 << 40])
def test_top_k_with_shares_and_other_columns(spark, monkeypatch, size):
    """Several copies of every block, queries that pass one of them, columns named like the operator's own; against all products."""
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "SHARE", 2)
    pick = random.Random(3)
    rows = [(i, [float(pick.randrange(-4, 5) * size) for _ in range(5)], i, "x", b"y", 1, 2) for i in range(90)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, block int, ids string, data binary, share int, v int")
    got: dict[int, list[tuple[int, int]]] = {}
    for r in top_k(integer_vectors(table, scale=1), F.col("vec_id") % 3 == 0, 7).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    high = 2**63 - 1
    whole = {r[0]: [int(x) for x in r[1]] for r in rows}
    for q in range(0, 90, 3):
        scores = [(i, max(-high - 1, min(high, sum(a * b for a, b in zip(whole[q], v))))) for i, v in whole.items() if i != q]
        assert got[q] == sorted(scores, key=lambda x: (-x[1], x[0]))[:7]


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 100), ("c", 0)], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(sizes).collect()}
    assert got["a"] == 30.0 and got["c"] == 0.0 and sum(got.values()) == pytest.approx(1110)
    assert got[None] == 300.0 and got["b"] == pytest.approx(780)


def test_mix_repeats_whole_documents(spark):
    docs = spark.createDataFrame([(k, f"w{k} x y", "ab"[k % 2]) for k in range(40)], "doc_id long, text string, source string")
    got = mixed_documents(docs, word_count(F.col("text"))).groupBy("source").count().collect()
    assert {r["source"]: r["count"] for r in got} == {"a": 29, "b": 11}


def test_running_total(spark):
    n = 1000
    row = spark.range(1).select(personal_data.running_total(F.sequence(F.lit(1).cast("bigint"), F.lit(n).cast("bigint"))).alias("t")).first()
    assert row["t"] == [k * (k - 1) // 2 for k in range(1, n + 1)]


def test_bootstrapped_patterns_find_unseen_identifiers(spark):
    seeds = [(k, f"Some text. Call office: +1 (743) 555-38{k:02d} today") for k in range(12)]
    unseen = [(100 + k, f"More text. Call office: 743-555-99{k:02d} today") for k in range(2)]
    clean = [(200 + k, f"It was built in 19{k:02d} and sold 12345678{k:02d} units") for k in range(10)]
    docs = spark.createDataFrame(seeds + unseen + clean, "doc_id long, text string")
    got = {r["doc_id"]: r for r in personal_data.find_personal_data(docs).collect()}
    for i, text in unseen:
        assert [text[x["start"] : x["end"]] for x in got[i]["found"]] == [text.split()[4]]
        assert got[i]["found"][0]["kind"] == 3
    assert all(not got[i]["found"] for i, _ in seeds + clean)


def test_licence_forms(spark):
    texts = ["Licensed under the Apache Licence, version 2.0", "LICENSED  under the apache license version 2!", "Licensed under the Apache License", "licence licence"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(licenses.digest(F.col("t")).alias("d"), "t").collect()
    assert rows[0]["d"] == rows[1]["d"] != rows[2]["d"]
    whole = spark.createDataFrame([(1, "Copyright (c) 2020 Me\n" + licenses.KNOWN[0][1].upper())], "doc_id long, text string")
    found = licenses.scan_licenses(whole, licenses.known_licenses(spark)).first()
    assert (found["whole_license"], found["licenses"]) == ("MIT", "MIT")


@pytest.mark.parametrize("seed", range(3))
def test_packing_of_histograms(seed):
    rng = np.random.default_rng(seed)
    histogram = {int(k): int(n) for k, n in zip(rng.integers(1, 2049, 60), rng.integers(1, 500, 60))}
    places, sequences = packing.solve(histogram, 2048)
    used = {}
    for length, rank, uses, _, _ in zip(*(places[c].tolist() for c in ("length", "rank", "uses", "sequence", "offset"))):
        assert rank == used.get(length, 0)
        used[length] = rank + uses
    assert used == {k: n for k, n in histogram.items() if k < 2048}
    sizes = np.array(sorted(used))
    plain = brute.best_fit(sizes, np.array([used[k] for k in sizes.tolist()]), 2048)
    assert sum(k * n for k, n in used.items()) / 2048 <= sequences <= sum(often for _, often in plain)


@pytest.mark.parametrize("times", [1, 100])
def test_the_program_places_every_piece_of_a_large_histogram(times):
    rng = np.random.default_rng(9)
    found = np.unique(np.minimum(2047, np.maximum(1, rng.lognormal(6.2, 1.0, 4000).astype(int))), return_counts=True)
    sizes, counts = found[0], found[1] * times
    used, sequences = np.zeros(len(sizes), int), 0
    for key, often in packing.configurations(sizes, counts, 2048):
        assert sum(int(sizes[k]) * n for k, n in key) <= 2048
        sequences += often
        for k, n in key:
            used[k] += often * n
    assert (used == counts).all()
    assert sequences <= 1.002 * float(sizes @ counts) / 2048 + 1


def test_token_ids_on_request(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = packing.tokenized_pieces(docs, tokenizer_path(), with_ids=True).first()
    assert row["length"] == len(row["ids"]) and row["ids"][-1] == 0

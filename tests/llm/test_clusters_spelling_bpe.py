"""Centroid clusters, spelling variants and the byte-pair round trip against plain Python and the library."""

import random

import brute
import numpy as np
import pytest
from odd_tables import SCHEMA, odd_rows, write
from pyspark.sql import functions as F

from edaphon.llm import bpe, centroids, spelling
from edaphon.llm.queries import QUERIES, tokenizer_path

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["odd", "small"])
def docs(request, spark):
    """(folder, rows of id and text)"""
    folder = request.getfixturevalue("odd") if request.param == "odd" else SMALL
    return folder, [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


# clusters


def test_hilbert_places_are_a_walk():
    grid = np.array(np.meshgrid(*[range(8)] * 3)).reshape(3, -1).T
    places = [p.tobytes() for p in centroids.hilbert_places(grid, 3)]
    walk = grid[sorted(range(len(grid)), key=places.__getitem__)]
    assert len(set(places)) == len(grid)
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()  # each step goes to a neighbour


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(1)
    points = rng.integers(-50, 50, (12, 5))
    skipped = 0
    for _ in range(50):
        data = rng.integers(-50, 50, 5) + rng.integers(-8, 8, (30, 5))
        low, high = data.min(axis=0), data.max(axis=0)
        skipped += len(points) - len(centroids.candidates(low, high, points))
        cluster, distance = centroids.nearest(data, low, high, points)
        want = ((data[:, None] - points) ** 2).sum(axis=2)
        assert cluster.tolist() == want.argmin(axis=1).tolist() and distance.tolist() == want.min(axis=1).tolist()
    assert skipped > 50


@pytest.mark.parametrize("block", [centroids.BLOCK, 7])
def test_clusters(spark, block, monkeypatch):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rng = np.random.default_rng(2)
    middles = rng.normal(0, 1, (6, 4))
    rows = [(i, (middles[i % 6] + rng.normal(0, 0.2, 4)).tolist()) for i in range(150)]
    rows += [rows[3]] * 60 + [(None, [0.5, 0.25, -0.125, 9.0])] + [(7, [0.0, -0.001, 0.0, 0.0])]  # copies, no id, one id twice
    nan, inf = float("nan"), float("inf")
    bad = [(900, None), (901, []), (902, [1.0] * 3), (903, [nan] * 4), (904, [1.0, -inf, 0.0, 0.0]), (905, [None, 0.0, 0.0, 0.0]), (906, [1e300] * 4)]
    frame = spark.createDataFrame([(i, v, 5, "x") for i, v in rows + bad], "vec_id long, embedding array<double>, cluster int, place string")
    vectors = centroids.integer_vectors(frame, width=4)
    assigned, found = centroids.centroid_clusters(vectors, count=9, rounds=5, width=4)
    got = [tuple(r) for r in centroids.with_inertia(assigned, found).collect()]
    assert sorted(got, key=repr) == sorted(brute.clusters(rows, 9, 5), key=repr)


def test_large_components_are_exact(spark):
    rows = [(k, [70000.0 * k, -300000.0 + k, 0.0, 1.0]) for k in range(8)]
    vectors = centroids.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), width=4)
    assigned, found = centroids.centroid_clusters(vectors, count=3, rounds=2, width=4)
    got = [tuple(r) for r in centroids.with_inertia(assigned, found).collect()]
    assert sorted(got) == sorted(brute.clusters(rows, 3, 2))


def test_fewer_vectors_than_centroids(spark):
    vectors = spark.createDataFrame([(1, [0, 0]), (2, [4, 4]), (None, [3, 4])], "vec_id long, v array<long>")
    assigned, found = centroids.centroid_clusters(vectors, count=40, rounds=1, width=2)
    assert len(found) == 2 and assigned.count() == 3
    assert centroids.centroid_clusters(vectors.filter("vec_id is null"), width=2)[0].count() == 0


# spelling


@pytest.mark.parametrize("sizes", [None, (40, 60, 4, 300)])
def test_spelling(spark, docs, sizes, monkeypatch):
    for name, value in zip(("CELL", "BLOCK", "LEAF", "TABLE"), sizes or ()):
        monkeypatch.setattr(spelling, name, value)
    folder, rows = docs
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in QUERIES["op12_spelling_variants"](spark, folder).collect()}
    assert got == brute.spelling(rows)


def spelled_rows() -> list[tuple]:
    """Chains of ever rarer spellings, anagrams, accents, very long words, copies."""
    pick = random.Random(4)
    rows = [(k, "important " * 400) for k in range(3)] + [(k, "importent " * 30) for k in range(10, 13)] + [(20, "inportent " * 4), (21, "importn importn")]
    rows += [(30 + k, "".join(pick.sample("abcdefgh", 8)) + " ") for k in range(300)] * 2
    rows += [(400, "Ärgerliche ärgerliche Ärgerliche ärgerliche Ñandúes×÷ Ñandúes×÷"), (401, "x" * 3000 + " " + "x" * 3001), (402, "x" * 3000 + " " + "x" * 3001)]
    return rows + [(None, "orphaned orphaned orphand orphand"), (403, None), (404, ""), (405, "ORPHANED oRPHANED")]


@pytest.mark.parametrize("sizes", [None, (20, 30, 2, 50)])
def test_spelling_of_chains_and_anagrams(spark, sizes, monkeypatch):
    for name, value in zip(("CELL", "BLOCK", "LEAF", "TABLE"), sizes or ()):
        monkeypatch.setattr(spelling, name, value)
    rows = spelled_rows()
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, n int, word string")
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.spelling_variants(spelling.word_counts(frame)).collect()}
    assert got == brute.spelling(rows)
    assert any(root != form for form, root, *_ in got.values() if form)  # a chain was followed


def test_one_edit():
    pick = random.Random(6)
    words = ["".join(pick.choice("ab") for _ in range(pick.choice((7, 8)))) for _ in range(60)]
    for a in words:
        for b in words:
            if len(a) <= len(b):
                got = bool(spelling.one_edit(spelling.letters([a]), spelling.letters([b]))[0])
                assert got == (a != b and brute.one_edit(tuple(a), tuple(b)))


# byte pairs


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(tokenizer_path("word_bpe_49k.json"))


def ids_of(vocabulary, text: str) -> list[int]:
    return np.frombuffer(vocabulary.encode(text), np.int32).tolist()


def test_round_trip(spark, docs, library):
    folder, rows = docs
    want = {}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want[i] = (len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False)))
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op13_bpe_round_trip"](spark, folder).collect()} == want


def test_words_of_few_letters(vocabulary, library):
    """Repeats and overlaps of frequent pairs make longest matches fail and step back."""
    pick = random.Random(7)
    for letters in ("ab", "aeinrst", "the an", "ñéa'0!", "…“’—"):
        for _ in range(800):
            text = "".join(pick.choice(letters) for _ in range(pick.randrange(1, 40)))
            assert ids_of(vocabulary, text) == library.encode(text, add_special_tokens=False).ids, text


def test_every_character(vocabulary, library):
    texts = [f"a{chr(c)}b!{chr(c)}?7 {chr(c)}" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    texts += [f"Σ{chr(c)}x" for c in range(0x3100, 0x110000, 37) if not 0xD800 <= c < 0xE000]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ids_of(vocabulary, text) == found.ids, repr(text)


def test_special_tokens_white_space_and_long_pieces(vocabulary, library):
    for text in ("x<|endoftext|>y <|startoftext|><|endoftext|", "a\x1c!\x1d!  b\x85c é ́e", "ab" * 40000, "it's I'LL don't", "e" + "́" * 70):
        assert ids_of(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_caches_may_be_small(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 3)
    monkeypatch.setattr(bpe, "PAIRS", 2)
    text = "several different words of a sentence, several different words again"
    assert ids_of(vocabulary, text) == library.encode(text, add_special_tokens=False).ids


def test_vocabularies_of_another_kind_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(tokenizer_path("byte_bpe_50k.json"))


def test_decoding_lists(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "GATHER", 2)
    rows = [(1, [320, 1929, 49407]), (2, []), (3, None), (4, [320, None, 10**6, -4, 1929])]
    frame = spark.createDataFrame([(i, v, "old") for i, v in rows], "doc_id long, ids array<int>, decoded string")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode_documents(frame, tokenizer_path("word_bpe_49k.json")).collect()}
    assert got == {1: library.decode([320, 1929, 49407], skip_special_tokens=False), 2: "", 3: None, 4: library.decode([320, 1929], skip_special_tokens=False)}


def test_other_columns_stay(spark):
    frame = spark.createDataFrame([(1, "a b", 7, "q"), (None, None, 8, None)], "doc_id long, text string, ids int, source string")
    out = bpe.encode_documents(frame, tokenizer_path("word_bpe_49k.json"))
    assert out.columns == ["doc_id", "text", "source", "ids"]
    assert sorted(map(len, (r["ids"] for r in out.collect()))) == [0, 2]


@pytest.mark.parametrize("name", ["op12_spelling_variants", "op13_bpe_round_trip"])
def test_clashing_columns_and_repeats(spark, tmp_path, name):
    rows = [(None if r[0] % 11 == 3 else r[0], *r[1:], -1, "x", "y") for r in odd_rows()]
    folder = write(spark, tmp_path, rows * 2, f"{SCHEMA}, n long, ids string, word string")
    frame = QUERIES[name](spark, folder)
    assert len(set(frame.columns)) == len(frame.columns) and frame.count() >= 1
    if name == "op13_bpe_round_trip":
        assert frame.count() == 2 * len(rows)
        assert frame.groupBy("doc_id").agg(F.countDistinct("ids_sha256").alias("n")).filter("n > 1 and doc_id is not null").count() == 0

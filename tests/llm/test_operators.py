"""Every query of the folder against plain Python or SQL."""

import pytest
import brute
from brute import words
from oracle import compare

from edaphon.llm import line_dedup, ngram_lm, simhash, substring_dedup, topk
from edaphon.llm.queries import QUERIES, SQL, tokenizer_path

SMALL = "/root/testdata/sf0.001"


def by_id(frame) -> dict:
    rows = frame.collect()
    out = {row["doc_id"]: row for row in rows}
    assert len(out) == len(rows)
    return out


@pytest.fixture(scope="module", params=["odd", "small"])
def case(request, spark):
    """(folder, id -> text)"""
    if request.param == "odd":
        return request.getfixturevalue("odd"), request.getfixturevalue("odd_docs")
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return SMALL, {row[0]: row[1] for row in rows}


@pytest.mark.parametrize("chunk, wide", [(substring_dedup.CHUNK_BYTES, substring_dedup.WIDE), (700, 2)])
def test_substring_dedup(spark, case, chunk, wide, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(substring_dedup, "WIDE", wide)
    folder, docs = case
    got = by_id(QUERIES["op1_substring_dedup"](spark, folder))
    assert {i: tuple(row)[1:] for i, row in got.items()} == brute.substring_dedup(docs)


def test_source_mixing(spark, case):
    folder, docs = case
    got = by_id(QUERIES["op2_source_mixing"](spark, folder))
    sizes, taken, largest = {}, {}, {}
    for i, row in got.items():
        assert row["size"] == len(words(docs[i]))
        assert 0 <= row["taken"] <= 3 * row["size"]
        assert row["taken"] == row["copies"] * row["size"]
        s = row["source"]
        sizes[s] = sizes.get(s, 0) + row["size"]
        taken[s] = taken.get(s, 0) + row["taken"]
        largest[s] = max(largest.get(s, 0), row["size"])
    target = brute.mixing_targets(sizes)
    for row in got.values():
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(target[row["source"]], rel=1e-9)
    for s in sizes:
        # whole documents come within half a document of the target, most far nearer
        assert abs(target[s] - taken[s]) <= max(largest[s] / 2, 0.02 * target[s])
    again = by_id(QUERIES["op2_source_mixing"](spark, folder))
    assert again == got


def test_personal_data(spark, case):
    folder, docs = case
    for i, row in by_id(QUERIES["op3_personal_data"](spark, folder)).items():
        base, spans = brute.personal_data(docs[i])
        assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"], row["base_sha256"]) == base, docs[i][:80]
        assert set(spans) <= set(row["spans"].split(",")) | {""}


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


@pytest.mark.parametrize("block", [topk.BLOCK, 40])
def test_top_k_in_blocks(spark, duck, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    assert compare(QUERIES["op4_exact_top_k"](spark, SMALL), duck, SQL["op4_exact_top_k"]) is None


@pytest.mark.parametrize("chunk", [line_dedup.CHUNK_BYTES, 700])
def test_line_dedup(spark, case, chunk, monkeypatch):
    monkeypatch.setattr(line_dedup, "CHUNK_BYTES", chunk)
    folder, docs = case
    got = by_id(QUERIES["op5_line_dedup"](spark, folder))
    assert {i: tuple(row)[1:] for i, row in got.items()} == brute.line_dedup(docs)


@pytest.mark.parametrize("group", [simhash.GROUP, 2])
def test_simhash(spark, case, group, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", group)
    folder, docs = case
    prints = {i: brute.fingerprint(text) for i, text in docs.items()}
    roots = brute.near_duplicates(prints)
    got = by_id(QUERIES["op6_simhash_duplicates"](spark, folder))
    assert {i: tuple(row)[1:] for i, row in got.items()} == {i: (f"{prints[i]:016x}", roots[i]) for i in docs}


@pytest.mark.parametrize("shard", [ngram_lm.SHARD_PAIRS, 500])
def test_kneser_ney(spark, case, shard, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_PAIRS", shard)
    folder, docs = case
    want, tokens = brute.kneser_ney(docs)
    got = by_id(QUERIES["op7_kneser_ney"](spark, folder))
    held = [0.0, 0.0]
    for i, row in got.items():
        is_held, n, known, base, score = want[i]
        assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"]) == (is_held, n, known, tokens)
        assert row["base_score"] == pytest.approx(base, rel=1e-9)
        assert row["score"] == pytest.approx(score, rel=1e-9)
        held = [held[0] + is_held * base, held[1] + is_held * score]
    if folder == SMALL:  # context must help on text that was not counted
        assert held[1] > held[0]


def test_best_fit_packing(spark, case):
    import zlib

    import numpy as np
    from tokenizers import Tokenizer

    folder, docs = case
    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = QUERIES["op8_best_fit_packing"](spark, folder).collect()
    pieces, places = {}, {}
    for row in rows:
        pieces.setdefault(row["doc_id"], []).append(row)
        places.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    assert pieces.keys() == docs.keys()
    total = 0
    for i, found in pieces.items():
        ids = np.array([*tokenizer.encode(docs[i] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        total += len(ids)
        at = 0
        for k, row in enumerate(sorted(found, key=lambda r: r["piece"])):
            assert (row["piece"], row["start"]) == (k, at)
            assert row["length"] == 2048 or k == 0
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            at += row["length"]
        assert at == len(ids)
    for found in places.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= 1.02 * total / 2048 + 2


def test_quality_rules(spark, case):
    folder, docs = case
    for i, row in by_id(QUERIES["op10_quality_rules"](spark, folder)).items():
        want = brute.quality(docs[i])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"], row["base_failed"]) == want
        assert not (row["kept"] and row["base_failed"])

"""Bootstrapped contexts of personal data."""

import random

import brute
import pytest

from edaphon.llm import personal_data


def found(spark, docs):
    rows = personal_data.find_personal_data(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    text = dict(docs)
    return {r["doc_id"]: [(x["kind"], text[r["doc_id"]][x["start"] : x["end"]]) for x in r["found"]] for r in rows}


@pytest.mark.parametrize("unseen", [4, 8, 24, 200])
def test_unseen_values_do_not_speak_against_their_pattern(spark, unseen):
    seeds = [(k, f"Some text. Call office: +1 (743) 555-38{k:02d} today") for k in range(12)]
    new = [(1000 + k, f"More text. Call office: 743-555-9{k:03d} today") for k in range(unseen)]
    words = [(2000 + k, f"More text. Call office: {word} today") for k, word in enumerate(["24h", "now", "b2b"])]
    clean = [(3000 + k, f"It was built in 19{k:02d} and sold 12345678{k:02d} units") for k in range(10)]
    got = found(spark, seeds + new + words + clean)
    for i, text in new:
        assert got[i] == [(3, text.split()[4])]
    assert not any(got[i] for i, _ in seeds + words + clean)


def test_patterns_of_mixed_company_find_nothing(spark):
    """As many words that are no identifiers, or seeds of another kind, as seeds."""
    seeds = [(k, f"see +1 (743) 555-38{k:02d} there") for k in range(8)]
    years = [(100 + k, f"see {1900 + k} there") for k in range(8)]
    new = [(200 + k, f"see 743-555-99{k:02d} there") for k in range(4)]
    assert not any(found(spark, seeds + years + new).values())
    hosts = [(100 + k, f"see 10.0.0.{k} there") for k in range(8)]
    assert not any(found(spark, seeds + hosts + new).values())


def test_found_values_carry_on_to_new_patterns(spark):
    """No seed stands in the second context, only values found in the first."""
    seeds = [(k, f"call: +1 (743) 555-38{k:02d} today") for k in range(12)]
    bridge = [(100 + k, f"call: 743-555-99{k:02d} today") for k in range(12)]
    again = [(200 + k, f"dial 743-555-99{k:02d} please") for k in range(12)]
    new = [(300, "dial 743-555-7777 please")]
    got = found(spark, seeds + bridge + again + new)
    assert got[300] == [(3, "743-555-7777")] and all(got[i] for i, _ in bridge + again)


@pytest.mark.parametrize("seed", range(4))
def test_scores_against_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = {(f"p{rng.randrange(12)}", rng.choice([0, 0, 0, 0, 0, 0, 1, 3, -1]), f"v{rng.randrange(60)}"): rng.random() < 0.6 for _ in range(250)}
    edges = [(p, k, v, is_seed and k >= 0) for (p, k, v), is_seed in edges.items()]
    table = spark.createDataFrame(edges, "pattern string, kind int, value string, seed boolean")
    options = {"min_confidence": 0.4, "min_trust": 0.5}
    got = {(r["value"], r["kind"]): r["trust"] for r in personal_data.value_trust(table, **options).collect()}
    want = brute.value_trust(edges, **options)
    assert want and got.keys() == want.keys()
    assert all(abs(got[key] - trust) < 1e-9 for key, trust in want.items())

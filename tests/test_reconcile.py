import random

import pytest
from pyspark.sql import functions as F

from edaphon.functions.spectrum import narrow, widen
from edaphon.operators import gold as O
from edaphon.operators import quality as Q
from edaphon.operators.dedup import first_per_key, without_repeats
from edaphon.operators.reconcile import (
    coalesced_targets,
    full_outer,
    hot_cells,
    lab_join,
    merged_labs,
    silver_master,
    with_lab_row,
)
from edaphon.sources.lab_tables import LAB_TARGETS

NAN = float("nan")


def labs_of(spark, seed, keys=6, rows=40):
    rng = random.Random(seed)

    def value():
        return rng.choice([None, 1.0, 2.0, 3.0])

    def key():
        return rng.choice([None, *[f"k{i}" for i in range(keys)]])

    return {
        "rres": spark.createDataFrame([(key(), value(), value()) for _ in range(rows)], "SSN string, pH double, `%C` double"),
        "icraf": spark.createDataFrame([(key(), value(), value()) for _ in range(rows)], "SSN string, `%C` double, ExBas double"),
        "cropnuts": spark.createDataFrame([(key(), value()) for _ in range(rows)], "SSN string, ExBas double"),
    }


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_join(labs):
    """The joins written out, as a check."""
    r = labs["rres"].toDF("SSN", "a", "b")
    i = labs["icraf"].toDF("SSN", "c", "d")
    c = labs["cropnuts"].toDF("SSN", "e")
    return r.join(i, "SSN", "full_outer").join(c, "SSN", "full_outer")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("hot_rows", [1_000_000, 4, 0])
def test_full_outer_with_hot_keys(spark, seed, hot_rows):
    labs = labs_of(spark, seed)
    assert sorted_rows(lab_join(labs, hot_rows=hot_rows)) == sorted_rows(plain_join(labs))


@pytest.mark.parametrize("hot_rows", [0, 1, 2, 3, 100])
def test_full_outer_sides(spark, hot_rows):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("x", 5), ("x", 5), ("", 6)], "SSN string, l int")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 30), ("c", 40), ("a", 10)], "SSN string, r int")
    census = Q.key_census({"n_left": left, "n_right": right})
    want = sorted_rows(left.join(right, "SSN", "full_outer"))
    assert sorted_rows(full_outer(left, right, "SSN", hot_cells(census, hot_rows))) == want
    assert sorted_rows(full_outer(left, right, "SSN")) == want


def test_key_that_is_hot_as_a_product_is_spread(spark):
    """300 rows on each side: under the limit in either table, 90,000 pairs together."""
    left = spark.range(300).select(F.expr("substring('kk', 1 + int(id % 2), 1)").alias("SSN"), F.col("id").alias("l"))
    right = spark.range(300).select(F.expr("substring('kk', 1 + int(id % 2), 1)").alias("SSN"), F.col("id").alias("r"))
    cells = hot_cells(Q.key_census({"n_left": left, "n_right": right}), 1000)
    row = cells.first()
    assert row["_both"] and row["_cut_l"] == row["_cut_r"] == 10
    assert full_outer(left, right, "SSN", cells).distinct().count() == 90_000
    # or these few rows would be broadcast, and put together again after a shuffle
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        for hot, alone in ((cells, False), (None, True)):
            joined = full_outer(left, right, "SSN", hot)
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert sum(sizes) == 90_000 and (len(sizes) == 1) == alone and (max(sizes) < 60_000) != alone
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_cells_hold_few_pairs(spark):
    counts = [("big", 10**9, 1), ("one_side", 10**9, 0), ("both", 10**7, 10**7), ("cold", 900, 900), (None, 10**9, 10**9)]
    got = {r["_hot"]: r for r in hot_cells(spark.createDataFrame(counts, "key string, n_left long, n_right long")).collect()}
    assert got.keys() == {"big", "one_side", "both"} and not got["one_side"]["_both"]
    for key, n_left, n_right in counts[:3]:
        r = got[key]
        assert n_left / r["_cut_l"] * max(n_right, 1) / r["_cut_r"] <= 1_000_000
        copies = n_left * (r["_cut_r"] - 1) + n_right * (r["_cut_l"] - 1)
        assert copies <= n_left * max(n_right, 1) / 400


@pytest.mark.parametrize("seed", range(4))
def test_merged_labs_is_one_of_the_combinations(spark, seed):
    labs = labs_of(spark, seed)
    combinations = set(map(tuple, coalesced_targets(labs).select("SSN", "pH", "%C", "ExBas").collect()))
    merged = [tuple(r) for r in merged_labs(labs).select("SSN", "pH", "%C", "ExBas").collect()]
    assert len({m[0] for m in merged}) == len(merged) == len({c[0] for c in combinations})
    assert set(merged) <= combinations


def test_merged_labs_ignores_row_order(spark):
    labs = labs_of(spark, 7)
    shuffled = {n: t.orderBy(F.rand(1)).repartition(5) for n, t in labs.items()}
    assert sorted_rows(merged_labs(labs)) == sorted_rows(merged_labs(shuffled))


def test_silver_master(spark):
    labs = {
        "rres": spark.createDataFrame([("a", 6.0), (None, 5.0)], "SSN string, pH double"),
        "icraf": spark.createDataFrame([("a", 9.0, 1.0), ("b", None, 2.0)], "SSN string, pH double, ExBas double"),
        "cropnuts": spark.createDataFrame([(None, 3.0), ("b", 4.0)], "SSN string, `ECEC cmolc/ kg soil` double"),
    }
    spectra = spark.createDataFrame(
        [("a", "f", [1.0]), ("z", "g", [2.0])], "SSN string, file_name string, spectrum array<double>"
    )
    silver = silver_master(spectra, labs)
    assert silver.columns == ["ssn", "ph", "ecec_cmolc__kg_soil", "exbas", "spectrum"]
    assert sorted_rows(silver) == sorted(
        [("a", 6.0, None, 1.0, [1.0]), ("b", None, 4.0, 2.0, None), (None, 5.0, None, None, None)], key=repr
    )


def test_unmeasured_targets_are_left_out(spark):
    labs = {"rres": spark.createDataFrame([("a", 6.0)], "SSN string, pH double")}
    assert merged_labs(labs).columns == ["SSN", "pH"]
    assert set(merged_labs(labs).columns) <= {"SSN", *LAB_TARGETS}


def test_first_per_key_keeps_one_null_key(spark):
    rows = spark.createDataFrame([(None, 2), (None, 1), ("a", None), ("a", 3)], "k string, v int")
    assert sorted_rows(first_per_key(rows, ["k"], ["v"])) == sorted([(None, 1), ("a", 3)], key=repr)


def test_without_repeats_keeps_the_same_rows(spark):
    rows = spark.createDataFrame(
        [("a", "f2", 1), ("a", "f1", 2), ("b", "f3", 3), (None, "f5", 4), (None, "f4", 5), ("a", "f0", 6)],
        "k string, name string, v int",
    )
    assert sorted_rows(without_repeats(rows, ["k"], "name")) == sorted_rows(first_per_key(rows, ["k"], ["name"]))
    once = rows.filter("v in (3, 6)")
    assert sorted_rows(without_repeats(once, ["k"], "name")) == sorted_rows(once)


SILVER = "ssn string, ph double, pct_c double, spectrum array<double>"


def test_gold_drops_null_and_nan(spark):
    silver = spark.createDataFrame(
        [
            ("a", 7.0, 1.0, [1.0, 2.0]),
            ("b", None, 1.0, [1.0, 2.0]),
            ("c", NAN, 1.0, [1.0, 2.0]),
            ("d", 7.0, 1.0, [1.0, None]),
            ("e", 7.0, 1.0, [1.0, NAN]),
            ("f", 7.0, 1.0, [1.0]),
            ("g", 7.0, 1.0, None),
            (None, 7.0, 1.0, [1.0, 2.0]),
        ],
        SILVER,
    )
    points = O.spectral_points(silver)
    assert points == 2
    assert [r["ssn"] for r in O.gold_table(silver, "ph", points).collect()] == ["a"]
    tidy = sorted((r["target"], r["ssn"]) for r in O.gold_tidy(silver, points).collect())
    assert tidy == [("carbono", "a"), ("carbono", "b"), ("carbono", "c"), ("ph", "a")]
    # the array rule is the wide table's dropna
    wide = widen(silver.select("ssn", "ph", "spectrum"), points).dropna()
    assert [r["ssn"] for r in wide.collect()] == ["a"]
    assert narrow(wide).first()["spectrum"] == [1.0, 2.0]


@pytest.mark.parametrize(
    ("rows", "status"),
    [
        ([("a", 7.0)], "success"),
        ([("a", 7.0), ("b", 15.0)], "success_with_invalid_target"),
        ([("a", 7.0), ("a", 15.0)], "success_with_duplicates"),
        ([("a", None)], "empty_gold_after_dropna"),
        ([], "empty_gold_after_dropna"),
    ],
)
def test_gold_audit_status(spark, rows, status):
    silver = spark.createDataFrame([(k, v, None, [1.0]) for k, v in rows], SILVER)
    audit = {r["gold_name"]: r for r in O.gold_audit(silver, 1).collect()}
    ph = audit["ph"]
    assert ph["status"] == status
    assert ph["input_rows"] == len(rows) == ph["output_rows"] + ph["dropped_rows"]
    assert (ph["pct_rows_dropped"] == 0) == (not rows or ph["dropped_rows"] == 0)
    assert audit["exbas"]["status"] == "failed" and audit["exbas"]["input_rows"] == 0
    assert audit["exbas"]["error_message"] == "Target exbas não existe"


def test_audit_of_written_tables(spark):
    silver = spark.createDataFrame(
        [("a", 7.0, -1.0, [1.0]), ("a", 15.0, None, [2.0]), ("b", None, 2.0, [3.0]), ("c", 1.0, 1.0, None),
         (None, 3.0, 3.0, [4.0])],
        SILVER,
    )
    gold = O.gold_tidy(silver, 1)
    direct, written = O.gold_counts(silver, 1), O.written_counts(silver, gold)
    assert direct.columns == written.columns and sorted_rows(direct) == sorted_rows(written)
    audit = {r["gold_name"]: r for r in O.audit_rows(written, 1).collect()}
    assert audit["ph"]["status"] == "success_with_duplicates" and audit["ph"]["invalid_target_rows"] == 1
    assert audit["carbono"]["status"] == "success_with_invalid_target" and audit["p"]["status"] == "failed"


def test_quality_counts_nan_as_out_of_range(spark):
    silver = spark.createDataFrame([("a", NAN, -1.0, None), ("b", 14.0, 0.0, [1.0]), ("c", None, NAN, [None])], SILVER)
    tables = {n: spark.createDataFrame([("a",), ("a",), (None,)], "SSN string") for n in (Q.SPECTRA, *Q.LABS)}
    got = {r["metric_name"]: r["metric_value"] for r in Q.silver_metrics(tables, silver).collect()}
    assert got["qtd_ph_fora_faixa_0_14"] == "1" and got["qtd_pct_c_negativo"] == "1"
    assert got["qtd_preenchido_ph"] == "2" and got["qtd_nulo_ph"] == "1"
    assert got["qtd_ssn_duplicado_wet_rres"] == "1" and got["qtd_ssn_nulo_wet_rres"] == "1"
    assert got["qtd_espectro_sem_wet"] == "1" and got["pct_cobertura_wet_com_espectro"] == "100.0"
    assert got["qtd_colunas_silver_final"] == "4" and got["qtd_nulo_wn_0"] == "2" and got["qtd_nulo_wn_9"] == "3"


def test_coverage_without_labs(spark):
    empty = spark.createDataFrame([], "SSN string")
    tables = {Q.SPECTRA: spark.createDataFrame([("a",)], "SSN string"), **dict.fromkeys(Q.LABS, empty)}
    row = Q.key_metrics(Q.key_census(tables), list(tables)).first()
    assert row["pct_cobertura_wet_com_espectro"] == 0 and row["qtd_espectro_sem_wet"] == 1


def test_metric_names(spark):
    silver = spark.createDataFrame([], "ssn string, " + ", ".join(f"{t} double" for t in Q.TARGETS) + ", spectrum array<double>")
    tables = {n: spark.createDataFrame([], "SSN string") for n in (Q.SPECTRA, *Q.LABS)}
    names = [r["metric_name"] for r in Q.silver_metrics(tables, silver).collect()]
    assert len(names) == len(set(names)) == 47




def test_guards(spark):
    silver = spark.createDataFrame([("a", 7.0, 1.0, [1.0])], SILVER)
    for missing in ("ssn", "ph", "spectrum"):
        with pytest.raises(KeyError, match=missing):
            O.gold_table(silver.drop(missing), "ph", 1)
    with pytest.raises(ValueError, match="wn_"):
        narrow(silver)


@pytest.mark.parametrize("buckets", [1, 3, 1 << 21])
def test_key_filter_keeps_what_laboratories_measured(spark, buckets):
    """Keys that share a bucket by chance stay and do no harm; NULL keys and empty laboratories neither."""
    schema = "SSN string, pH double"
    labs = {
        "rres": spark.createDataFrame([("icr1", 1.0), (None, 2.0)], schema),
        "icraf": spark.createDataFrame([("icr2", 3.0), ("icr1", 4.0)], schema),
        "cropnuts": spark.createDataFrame([], schema),
    }
    scans = [(f"icr{i}", [float(i)]) for i in range(50)] + [(None, [0.0])]
    spectra = spark.createDataFrame(scans, "SSN string, spectrum array<double>")
    kept = with_lab_row(spectra, labs, buckets)
    assert kept.columns == spectra.columns
    keys = {r["SSN"] for r in kept.collect()}
    assert {"icr1", "icr2"} <= keys and (buckets == 1) == (len(keys) == 51)
    if buckets > 3:
        assert keys <= {"icr1", "icr2", None}
    plain, filtered = (silver_master(s, labs, ["pH"]).orderBy("ssn").collect() for s in (spectra, kept))
    assert plain == filtered and [r["spectrum"] for r in filtered] == [None, [1.0], [2.0]]
    nothing = {n: lab.limit(0) for n, lab in labs.items()}
    assert with_lab_row(spectra, nothing, buckets).count() == 0

"""The four jobs, one after the other, on a small store."""

from datetime import datetime, timedelta, timezone

import numpy as np
import pytest

from edaphon.__main__ import arguments, main
from edaphon.modelling.search import LINEAR
from edaphon.plans.evaluate import Options
from edaphon.plans.jobs import PREFIXES, Lake, run_bronze, run_gold, run_models, run_silver, run_stamp
from edaphon.sinks.lake import gold_of, read_gold
from edaphon.sources.spectra import text_decoder

SAMPLES, POINTS = 120, 12


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    root = tmp_path_factory.mktemp("store")
    rng = np.random.default_rng(0)
    spectra, cropnuts, icraf, rres = (root / p for p in PREFIXES)
    for folder in (spectra, cropnuts, icraf, rres):
        folder.mkdir(parents=True)
    x = rng.normal(size=(SAMPLES, POINTS))
    for i in range(SAMPLES):
        content = "AB:" + ",".join(map(repr, x[i].tolist()))
        (spectra / f"icr{i:06d}.0").write_text("broken" if i == 5 else content)
    # a second measurement, which loses to the lower path
    (spectra / "re").mkdir()
    (spectra / "re" / "icr000003.0").write_text("AB:" + ",".join(["9"] * POINTS))
    ph = 7 + x[:, 0] * 0.5 + rng.normal(size=SAMPLES) * 0.05
    lines = [f"icr{i:06d},{ph[i]},{abs(x[i, 1]) + 0.1}" for i in range(SAMPLES)]
    (rres / "Wet_Chemistry_RRES.csv").write_text("SSN,pH, Olsen P mg/kg\n" + "\n".join(lines) + "\n")
    (icraf / "Wet_Chemistry_ICRAF.csv").write_text("SSN,pH,%C\nicr000001,99,1.5\nicr000001,98,1.0\n  ,3,9\nicr999999,20,-1\n")
    (cropnuts / "Wet_Chemistry_CROPNUTS.csv").write_text("SSN,ExBas\nicr000002,nonsense\n")
    return root


def test_jobs(spark, store, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    counters = {r["prefix"]: r for r in run_bronze(spark, lake, str(store), "t1").collect()}
    assert counters[None]["copied"] == SAMPLES + 4 and counters[None]["failed"] == 0
    again = {r["prefix"]: r for r in run_bronze(spark, lake, str(store), "t2").collect()}
    assert again[None]["skipped"] == SAMPLES + 4 and again[None]["copied"] == 0

    metrics = {r["metric_name"]: r["metric_value"] for r in run_silver(spark, lake, text_decoder, "t1").collect()}
    assert metrics["qtd_linhas_bronze_espectro"] == str(SAMPLES - 1)
    assert metrics["qtd_linhas_silver_final"] == str(SAMPLES + 2)
    assert metrics["qtd_ssn_nulo_wet_icraf"] == "1" and metrics["qtd_ssn_duplicado_wet_icraf"] == "1"
    assert metrics["qtd_colunas_espectrais_wn"] == str(POINTS) and metrics["qtd_nulo_exbas"] == str(SAMPLES + 2)
    status = spark.read.option("header", "true").csv(lake.path("validations", "spectra", "run_ts=t1"))
    assert {r["decode_status"]: r["files"] for r in status.collect()} == {"ok": str(SAMPLES), "no_spectrum": "1"}

    third = spark.read.parquet(lake.path("silver")).filter("ssn = 'icr000003'").collect()
    assert len(third) == 1 and third[0]["spectrum"][0] != 9
    comments = {f.name: f.metadata.get("comment") for f in spark.read.parquet(lake.path("silver")).schema.fields}
    assert comments["ph"] and comments["spectrum"]

    audit = {r["gold_name"]: r for r in run_gold(spark, lake, "t1").collect()}
    assert audit["ph"]["status"] == "success" and audit["ph"]["output_rows"] == SAMPLES - 1
    assert audit["ph"]["final_file_size"] > 0 and audit["ph"]["final_path"].endswith("gold/target=ph")
    assert audit["exbas"]["status"] == "empty_gold_after_dropna" and audit["ecec"]["status"] == "failed"
    first = gold_of(read_gold(spark, lake.path("gold")), "carbono", "pct_c").collect()
    assert [(r["ssn"], r["pct_c"]) for r in first] == [("icr000001", 1.0)]

    options = Options(models=LINEAR, linear_trials=10, log_targets=("p",))
    found = run_models(spark, lake, "t1", POINTS, options)
    assert list(found.skipped) == ["carbono"]
    best = {r["target"]: r for r in found.results.filter("position = 1").collect()}
    assert best["ph"]["test_r2"] > 0.8 and best["p"]["log_transform"]
    saved = spark.read.option("header", "true").csv(lake.path("results", "run_ts=t1"))
    assert saved.count() == 10 and "melhores_params" in saved.columns


def test_gold_from_a_wide_silver_replaces_the_table(spark, tmp_path):
    lake = Lake(str(tmp_path))
    rows = [("a", 7.0, 1.0, 0.1, 0.2), ("b", None, 2.0, 0.3, 0.4)]
    schema = "ssn string, ph double, pct_c double, wn_0 double, wn_1 double"
    spark.createDataFrame(rows, schema).write.parquet(lake.path("silver"))
    run_gold(spark, lake, "t1")
    found = {(r["target"], r["ssn"]): r["spectrum"] for r in read_gold(spark, lake.path("gold")).collect()}
    assert found == {("ph", "a"): [0.1, 0.2], ("carbono", "a"): [0.1, 0.2], ("carbono", "b"): [0.3, 0.4]}
    spark.createDataFrame(rows[1:], schema).write.mode("overwrite").parquet(lake.path("silver"))
    audit = {r["gold_name"]: r for r in run_gold(spark, lake, "t2").collect()}
    assert audit["ph"]["status"] == "empty_gold_after_dropna" and audit["ph"]["final_file_size"] == 0
    left = read_gold(spark, lake.path("gold")).select("target", "ssn").collect()
    assert [tuple(r) for r in left] == [("carbono", "b")]


def test_command_line(spark, tmp_path, capsys):
    source = tmp_path / "src" / "p"
    source.mkdir(parents=True)
    (source / "a").write_text("x")
    main(["bronze", "--lake", str(tmp_path / "lake"), "--source", str(tmp_path / "src"), "--prefix", "p/"])
    assert (tmp_path / "lake" / "bronze" / "p" / "a").read_text() == "x"
    assert "p/" in capsys.readouterr().out
    for bad in (["bronze", "--lake", "x"], ["models", "--lake", "x"], ["other", "--lake", "x"]):
        with pytest.raises(SystemExit):
            arguments(bad)


def test_run_stamp():
    assert run_stamp(datetime(2024, 5, 6, 7, 8, tzinfo=timezone(timedelta(hours=-3)))) == "2024-05-06-10-08"

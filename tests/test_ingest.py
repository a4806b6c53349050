import math
import os

import numpy as np
import pytest
from pyspark.sql.readwriter import DataFrameWriter

from edaphon.sinks import copy as C
from edaphon.sinks.lake import write_silver
from edaphon.sources import manifest as M
from edaphon.sources.lab_tables import LAB_TARGETS, read_lab_csv
from edaphon.sources.spectra import decode, decode_status, require_spectra, scan_spectra, spectra_base

RUN = {"execution_utc": "t", "source_bucket": "s", "dest_bucket": "d"}


@pytest.fixture
def store(tmp_path):
    files = {
        "p/a.0": b"AB:1.5,2",
        "p/sub/b.0": b"",
        "p/sub/bad.0": b"AB:x",
        "q/c.csv": b"SSN\n1\n",
        "r/other": b"zz",
    }
    for name, content in files.items():
        path = tmp_path / "src" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return tmp_path


def audit_of(spark, store, prefixes):
    source = M.object_manifest(spark, f"{store}/src", prefixes)
    before = M.object_manifest(spark, f"{store}/dst")
    audit = C.copy_objects(source, before, f"{store}/src", f"{store}/dst", prefixes, "bronze/", RUN)
    return {r["source_key"] or r["prefix"]: r.asDict() for r in audit.collect()}


def test_manifest(spark, store):
    got = {r["key"]: r["size"] for r in M.object_manifest(spark, f"{store}/src").collect()}
    assert got == {"p/a.0": 8, "p/sub/b.0": 0, "p/sub/bad.0": 4, "q/c.csv": 6, "r/other": 2}
    only = M.object_manifest(spark, f"{store}/src", ["p/sub", "p/", "none/"])
    assert sorted(r["key"] for r in only.collect()) == ["p/a.0", "p/sub/b.0", "p/sub/bad.0"]
    assert M.object_manifest(spark, f"{store}/nowhere").count() == 0


def test_copy_then_copy_again(spark, store):
    prefixes = ["p/", "q/", "none/"]
    first = audit_of(spark, store, prefixes)
    assert {k: v["status"] for k, v in first.items()} == {
        "p/a.0": "copied", "p/sub/b.0": "copied", "p/sub/bad.0": "copied", "q/c.csv": "copied", "none/": "empty_prefix",
    }
    assert (store / "dst/bronze/p/a.0").read_bytes() == b"AB:1.5,2"
    assert first["none/"]["error_message"] == C.EMPTY_MESSAGE and first["none/"]["source_size"] is None
    assert first["p/sub/b.0"]["dest_size"] == 0
    # an existing object is skipped even when its size differs
    (store / "dst/bronze/q/c.csv").write_bytes(b"longer than before")
    second = audit_of(spark, store, prefixes)
    assert {v["status"] for k, v in second.items() if k != "none/"} == {"skipped_existing"}
    assert second["q/c.csv"]["dest_size"] == 18
    assert not [f for _, _, names in os.walk(store / "dst") for f in names if f.startswith(".c.csv")]


def test_copy_failure_is_a_row(spark, store):
    listed = M.object_manifest(spark, f"{store}/src", ["p/"]).unionByName(
        spark.createDataFrame([("p/gone.0", 5)], "key string, size bigint")
    )
    none = M.object_manifest(spark, f"{store}/dst")
    audit = C.copy_objects(listed, none, f"{store}/src", f"{store}/dst", ["p/"], "bronze/", RUN)
    rows = {r["source_key"]: r for r in audit.collect()}
    assert rows["p/gone.0"]["status"] == "failed" and "gone.0" in rows["p/gone.0"]["error_message"]
    assert rows["p/a.0"]["status"] == "copied"
    counters = {r["prefix"]: r for r in C.copy_counters(audit).collect()}
    assert (counters[None]["found"], counters[None]["copied"], counters[None]["failed"]) == (4, 3, 1)
    assert counters["p/"]["zero_byte"] == 1


def test_wrong_listing_is_a_mismatch(spark, store):
    listed = spark.createDataFrame([("p/a.0", 9)], "key string, size bigint")
    none = M.object_manifest(spark, f"{store}/dst")
    audit = C.copy_objects(listed, none, f"{store}/src", f"{store}/dst", ["p/"], "bronze/", RUN)
    row = audit.collect()[0]
    assert (row["status"], row["dest_size"]) == ("copied_with_size_mismatch", 8)


def test_overlapping_prefixes_list_an_object_for_each(spark):
    listed = spark.createDataFrame([("a/b/c", 1), ("a/", 0)], "key string, size bigint")
    counts = {r["prefix"]: r["objects"] for r in M.prefix_counts(listed, ["a/", "a/b/", "z/"]).collect()}
    assert counts == {"a/": 1, "a/b/": 1, "z/": 0}


def test_scan_and_decode_files(spark, store):
    folder = store / "src" / "Bruker_Alpha_KBr"
    folder.mkdir()
    for name, content in {
        "icr001.0": b"AB:1,2,3", "icr002.0": b"SC:1", "icr003.0": b"\xff", "icr004.1": b"AB:9", "icr005.0": b"AB:1,nan,3", "icr006.0": b"",
    }.items():
        (folder / name).write_bytes(content)
    decoded = decode(scan_spectra(spark, f"{store}/src"))
    status = {r[0]: r[1] for r in decode_status(decoded).collect()}
    assert status == {"ok": 2, "no_spectrum": 2, "error": 1}
    base = {r["SSN"]: r for r in require_spectra(spectra_base(decoded)).collect()}
    assert sorted(base) == ["icr001", "icr005"] and base["icr001"]["spectrum"] == [1.0, 2.0, 3.0]
    assert base["icr001"]["file_name"] == "icr001.0" and base["icr001"]["sample_id"] == "001"
    with pytest.raises(ValueError, match="no spectrum"):
        require_spectra(spectra_base(decoded.filter("decode_status <> 'ok'")))


def test_decoder_results_that_are_no_spectrum(spark):
    answers = {b"list": [1, 2], b"array": np.array([3.0]), b"words": ["a"], b"table": [[1.0], [2.0]], b"hole": [None, 1.0], b"none": None}
    files = spark.createDataFrame([(f"{k.decode()}.0", bytearray(k)) for k in answers], "source string, content binary")
    got = {r["source"][:-2]: (r["decode_status"], r["spectrum"]) for r in decode(files, answers.__getitem__).collect()}
    assert got["list"] == ("ok", [1.0, 2.0]) and got["array"] == ("ok", [3.0])
    assert got["words"][0] == got["table"][0] == "error" and got["none"] == ("no_spectrum", None)
    assert got["hole"][0] == "ok" and math.isnan(got["hole"][1][0])


def test_lab_csv_with_stray_words(spark, tmp_path):
    path = tmp_path / "Wet_Chemistry_X.csv"
    path.write_text('SSN,pH,%C, Olsen P mg/kg,note\nicr1,6.5,bad,3,x\n"  ",7,1.5,,y\n')
    table = read_lab_csv(spark, str(path), "x")
    assert [t for t in LAB_TARGETS if t in table.columns] == ["pH", "%C", " Olsen P mg/kg"]
    rows = [tuple(r) for r in table.collect()]
    assert rows == [("icr1", 6.5, None, 3.0, "x"), (None, 7.0, 1.5, None, "y")]


def test_source_lookup(spark):
    listed = spark.createDataFrame([("b/x.csv", 1), ("a/x.csv", 1), ("c/", 0)], "key string, size bigint")
    found = M.keys_by_suffix(listed, ["x.csv"])
    assert M.require_keys(found) == {"x.csv": "a/x.csv"}
    with pytest.raises(FileNotFoundError, match="y.csv"):
        M.require_keys(M.keys_by_suffix(listed, ["x.csv", "y.csv"]))


def test_silver_falls_back_to_csv(spark, tmp_path, monkeypatch):
    silver = spark.createDataFrame([("a", 1.0, [0.5, 2.0]), ("b", None, None)], "ssn string, ph double, spectrum array<double>")
    assert write_silver(silver, f"{tmp_path}/ok") == (f"{tmp_path}/ok", "parquet")

    def fail(*_args, **_options):
        raise OSError("no room")

    monkeypatch.setattr(DataFrameWriter, "parquet", fail)
    path, used = write_silver(silver, f"{tmp_path}/s")
    assert used == "csv"
    back = spark.read.option("header", "true").csv(path).orderBy("ssn")
    assert back.columns == ["ssn", "ph", "wn_0", "wn_1"]
    assert [tuple(r) for r in back.collect()] == [("a", "1.0", "0.5", "2.0"), ("b", None, None, None)]

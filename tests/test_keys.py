from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from edaphon.functions import keys as K

PATHS = [
    "a/Bruker_Alpha_KBr/icr005928.0",
    "x/icr icr12 .0",
    "icr.tar.gz",
    "plain",
    "a/.hidden",
    "a/trailing.",
    "ICR9.0",
    "a.b/icr7",
]


def test_sample_id_follows_the_path_rules(spark):
    rows = spark.createDataFrame([(p,) for p in PATHS], "p string")
    got = {r[0]: (r[1], r[2]) for r in rows.select("p", K.sample_id(F.col("p")), K.file_name(F.col("p"))).collect()}
    for path in PATHS:
        # the stem rule of Python up to 3.13, where a trailing dot starts no suffix
        name = PurePosixPath(path).name
        dot = name.rfind(".")
        stem = name[:dot] if 0 < dot < len(name) - 1 else name
        assert got[path] == (stem.strip().replace("icr", "").strip(), name), path


@pytest.mark.parametrize(
    ("name", "snake"),
    [
        ("ECEC cmolc/ kg soil", "ecec_cmolc__kg_soil"),
        (" Olsen P mg/kg", "olsen_p_mg_kg"),
        ("%C", "pct_c"),
        ("pH", "ph"),
        ("Área (m²)", "rea_m"),
    ],
)
def test_names(spark, name, snake):
    assert K.snake_name(name) == snake
    row = spark.createDataFrame([(name,)], "n string").select(K.snake_name_of(F.col("n"))).first()
    assert row[0] == snake


def test_blank_key(spark):
    rows = spark.createDataFrame([("",), ("  ",), (" a ",), (None,)], "SSN string")
    got = [r[0] for r in K.with_clean_key(rows, "t").collect()]
    assert got == [None, None, " a ", None]
    with pytest.raises(KeyError):
        K.with_clean_key(rows.toDF("other"), "t")


def test_uri(spark):
    rows = spark.createDataFrame([("s3://bucket/a/b.csv",), ("https://h.org//x?q=1#f",), ("s3://only",)], "u string")
    got = [tuple(r) for r in rows.select(K.uri_bucket(F.col("u")), K.uri_key(F.col("u"))).collect()]
    assert got == [("bucket", "a/b.csv"), ("h.org", "x"), ("only", "")]

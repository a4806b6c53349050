"""The soil tables as views over the given tables, in Spark and in SQL.

Three laboratories with overlapping keys (rres ← part, icraf ← customer, cropnuts ← orders, the
last with replicates and blank keys, the second with replicates, the first with blank keys), spectra ← embeddings, objects ← pages, trial logs ← events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.keys import with_clean_key
from edaphon.modelling.split import with_folds
from edaphon.operators.gold import gold_tidy
from edaphon.operators.reconcile import silver_master

POINTS = 64  # length of the embeddings, the stand-in spectra
UNMEASURED = 900_000_000
TARGETS = ["ph", "pct_c", "olsen_p_mg_kg", "ecec_cmolc__kg_soil", "exbas"]
PREFIXES = ["de/", "en/", "es/", "fr/", "zz/none/"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ssn(number: Column) -> Column:
    return F.concat(F.lit("icr"), F.lpad(number.cast("string"), 12, "0"))


def raw_labs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The laboratories in priority order, blank keys still in."""
    part, customer, orders = (table(spark, sf, t) for t in ("part", "customer", "orders"))
    rres = part.select(
        F.when(F.col("p_partkey") % 89 == 0, F.lit(" ")).otherwise(ssn(F.col("p_partkey") * 3)).alias("SSN"),
        (F.col("p_size") / 4).alias("pH"),
        (F.col("p_retailprice") / 1000).alias("%C"),
        (F.col("p_size") * F.lit(1.5)).alias("ECEC cmolc/ kg soil"),
    )
    icraf = customer.select(
        ssn((F.col("c_custkey") - F.col("c_custkey") % 2) * 2).alias("SSN"),
        F.when(F.col("c_nationkey") >= 5, F.col("c_nationkey") / F.lit(1.6)).alias("pH"),
        (F.col("c_acctbal") / 1000).alias("%C"),
        (F.abs("c_acctbal") / 100).alias("ExBas"),
    )
    price = F.col("o_totalprice")
    cropnuts = orders.select(
        F.when(F.col("o_orderkey") % 97 == 0, F.lit("  ")).otherwise(ssn(F.col("o_custkey"))).alias("SSN"),
        (price / 100000).alias("%C"),
        (price / 5000).alias(" Olsen P mg/kg"),
        (price / 10000).alias("ExBas"),
    )
    return {"rres": rres, "icraf": icraf, "cropnuts": cropnuts}


def labs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {n: with_clean_key(t, n) for n, t in raw_labs(spark, sf).items()}


LABS_SQL = """
raw_rres as (select case when p_partkey % 89 = 0 then ' '
    else concat('icr', lpad(cast(p_partkey*3 as varchar), 12, '0')) end as ssn, p_size/4e0 as ph,
    p_retailprice/1000e0 as pct_c, cast(null as double) as olsen, p_size*1.5e0 as ecec,
    cast(null as double) as exbas from part),
raw_icraf as (select concat('icr', lpad(cast((c_custkey - c_custkey % 2) * 2 as varchar), 12, '0')) as ssn,
    case when c_nationkey < 5 then null else c_nationkey/1.6e0 end as ph, c_acctbal/1000e0 as pct_c,
    cast(null as double) as olsen, cast(null as double) as ecec, abs(c_acctbal)/100e0 as exbas from customer),
raw_cropnuts as (select case when o_orderkey % 97 = 0 then '  '
    else concat('icr', lpad(cast(o_custkey as varchar), 12, '0')) end as ssn, cast(null as double) as ph,
    o_totalprice/100000e0 as pct_c, o_totalprice/5000e0 as olsen, cast(null as double) as ecec,
    o_totalprice/10000e0 as exbas from orders),
rres as (select * replace (case when trim(ssn) = '' then null else ssn end as ssn) from raw_rres),
icraf as (select * replace (case when trim(ssn) = '' then null else ssn end as ssn) from raw_icraf),
cropnuts as (select * replace (case when trim(ssn) = '' then null else ssn end as ssn) from raw_cropnuts)"""


def spectrum_key() -> Column:
    """Some samples were scanned that no laboratory measured."""
    return ssn(F.col("vec_id") + F.when(F.col("vec_id") % 50 == 7, UNMEASURED).otherwise(0))


def spectra(spark: SparkSession, sf: str) -> DataFrame:
    """``(SSN, source, spectrum)``, one row per sample."""
    key = spectrum_key()
    return table(spark, sf, "embeddings").select(
        key.alias("SSN"),
        F.concat(F.lit("Bruker_Alpha_KBr/"), key, F.lit(".0")).alias("source"),
        F.col("embedding").cast("array<double>").alias("spectrum"),
    )


SPECTRA_SQL = """
spectra as (select concat('icr', lpad(cast(vec_id + case when vec_id % 50 = 7 then 900000000 else 0 end
    as varchar), 12, '0')) as ssn, vec_id, label,
    cast(embedding as double[]) as spectrum from embeddings)"""


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return silver_master(spectra(spark, sf), labs(spark, sf))


# each laboratory's lowest row of a key, then priority; of rows without a key the lowest
_LOWEST = ", ".join(
    f"low_{lab} as (select * from {lab} qualify row_number() over (partition by ssn order by ph nulls last, "
    "pct_c nulls last, olsen nulls last, ecec nulls last, exbas nulls last) = 1)"
    for lab in ("rres", "icraf", "cropnuts")
)
SILVER_SQL = f"""{LABS_SQL}, {SPECTRA_SQL}, {_LOWEST},
two as (select coalesce(r.ssn, i.ssn) as ssn, r.ph as rph, i.ph as iph, r.pct_c as rc, i.pct_c as ic,
    r.ecec as re, i.exbas as ix from low_rres r full outer join low_icraf i on r.ssn = i.ssn),
combined as (select coalesce(two.ssn, c.ssn) as ssn, coalesce(rph, iph) as ph, coalesce(rc, ic, c.pct_c) as pct_c,
    c.olsen as olsen_p_mg_kg, re as ecec_cmolc__kg_soil, coalesce(ix, c.exbas) as exbas
    from two full outer join low_cropnuts c on two.ssn = c.ssn),
numbered as (select *, row_number() over (partition by ssn order by ph nulls last, pct_c nulls last,
    olsen_p_mg_kg nulls last, ecec_cmolc__kg_soil nulls last, exbas nulls last) as rn from combined),
silver as (select n.ssn, n.ph, n.pct_c, n.olsen_p_mg_kg, n.ecec_cmolc__kg_soil, n.exbas, s.spectrum
    from numbered n left join spectra s on n.ssn = s.ssn where rn = 1)"""

WIDE_SQL = ", ".join(f"spectrum[{i + 1}] as wn_{i}" for i in range(POINTS))

# Gold name → target column, as SQL rows
GOLD_SQL = f"""{SILVER_SQL},
tidy as (
    select 'ph' as target, ssn, ph as y, spectrum from silver union all
    select 'carbono', ssn, pct_c, spectrum from silver union all
    select 'p', ssn, olsen_p_mg_kg, spectrum from silver union all
    select 'ecec', ssn, ecec_cmolc__kg_soil, spectrum from silver union all
    select 'exbas', ssn, exbas, spectrum from silver),
gold as (select * from tidy where ssn is not null and y is not null and spectrum is not null)"""


def gold(spark: SparkSession, sf: str) -> DataFrame:
    """``(target, ssn, y, spectrum)`` of all five targets."""
    return gold_tidy(silver(spark, sf), POINTS)


FOLD_SQL = """case when substr(md5({key} || '|42'), 1, 8) < '33333333' then -1
    when substr(md5({key} || '|fold42'), 1, 8) < '33333333' then 0
    when substr(md5({key} || '|fold42'), 1, 8) < '66666666' then 1
    when substr(md5({key} || '|fold42'), 1, 8) < '99999999' then 2
    when substr(md5({key} || '|fold42'), 1, 8) < 'cccccccc' then 3 else 4 end"""


def planted_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """``(target, ssn, fold, y, spectrum, label)`` with a target the spectra do explain."""
    base = table(spark, sf, "embeddings").select(
        F.lit("planted").alias("target"),
        spectrum_key().alias("ssn"),
        F.col("embedding").cast("array<double>").alias("spectrum"),
        "label",
    )
    x = [F.get("spectrum", F.lit(i)) for i in range(4)]
    y = 3 * x[0] - 2 * x[1] + x[2] * x[3] + F.col("label") / 100
    return with_folds(base.withColumn("y", y), "ssn").select("target", "ssn", "fold", "y", "spectrum", "label")


def planted(spark: SparkSession, sf: str) -> DataFrame:
    return planted_labelled(spark, sf).drop("label")


PLANTED_SQL = f"""{SPECTRA_SQL},
planted as (select ssn, label, spectrum, spectrum[1] as x0, spectrum[2] as x1,
    3*spectrum[1] - 2*spectrum[2] + spectrum[3]*spectrum[4] + label/100e0 as y,
    {FOLD_SQL.format(key="ssn")} as fold from spectra)"""


def objects(spark: SparkSession, sf: str) -> DataFrame:
    """``(url, key, size)``: pages as objects, keys by language and host, some folder markers."""
    url = F.col("url")
    key = F.concat(
        F.regexp_extract(url, r"^https?://[^/]+/([a-z]+)", 1),
        F.lit("/"),
        F.col("page_id").cast("string"),
        F.lit("/"),
        F.regexp_extract(url, r"^https?://([^/]+)/", 1),
        F.lit("/"),
        F.regexp_extract(url, r"^https?://[^/]+/[a-z]+/(.*)$", 1),
    )
    size = F.when(F.col("page_id") % 50 == 7, 0).otherwise(F.length("html")).cast("bigint")
    return table(spark, sf, "pages").select("url", key.alias("key"), size.alias("size"))


OBJECTS_SQL = r"""
objects as (select url, concat(regexp_extract(url, '^https?://[^/]+/([a-z]+)', 1), '/',
    cast(page_id as varchar), '/', regexp_extract(url, '^https?://([^/]+)/', 1), '/',
    regexp_extract(url, '^https?://[^/]+/[a-z]+/(.*)$', 1)) as key,
    cast(case when page_id % 50 = 7 then 0 else length(html) end as bigint) as size from pages)"""

PREFIX_SQL = "(values " + ", ".join(f"('{p}')" for p in PREFIXES) + ") as listed(prefix)"


def trial_log(spark: SparkSession, sf: str) -> DataFrame:
    """``(study, trial, step, score)``: studies of up to 100 trials and five steps."""
    step = (F.col("event_id") % 5).cast("int").alias("step")
    means = table(spark, sf, "events").groupBy("event_type", "user_id", step).agg(F.avg("value").alias("score"))
    study = F.concat_ws("/", "event_type", F.expr("user_id div 100").cast("string"))
    return means.select(study.alias("study"), (F.col("user_id") % 100).cast("int").alias("trial"), "step", "score")


TRIAL_LOG_SQL = """
trial_log as (select concat(event_type, '/', cast(user_id // 100 as varchar)) as study,
    cast(user_id % 100 as integer) as trial, cast(event_id % 5 as integer) as step, avg(value) as score
    from events group by 1, 2, 3)"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """List price times quantity as a prediction of the extended price, per brand."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.col("l_extendedprice").alias("y")
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    joined = items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.withColumn("yhat", F.col("l_quantity") * F.col("p_retailprice"))


PREDICTIONS_SQL = """
predictions as (select l_orderkey, l_linenumber, l_partkey, p_brand, l_extendedprice as y,
    l_quantity * p_retailprice as yhat from lineitem join part on l_partkey = p_partkey)"""

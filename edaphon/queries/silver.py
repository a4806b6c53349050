"""Reconciliation and quality queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.keys import blank_to_null, snake_name_of, with_clean_key
from edaphon.functions.spectrum import lengthen, widen
from edaphon.operators import quality as Q
from edaphon.operators.dedup import first_per_key
from edaphon.operators.reconcile import LINEAGE_COLUMNS, coalesced_targets, lab_join, silver_master, with_lab_row
from edaphon.queries.registry import query
from edaphon.queries.views import (
    LABS_SQL,
    POINTS,
    SILVER_SQL,
    SPECTRA_SQL,
    TARGETS,
    WIDE_SQL,
    labs,
    silver,
    spectra,
    table,
)
from edaphon.session import fresh_path, materialise
from edaphon.sinks.lake import read_report, write_report, write_silver

TARGET_LIST = ", ".join(TARGETS)


def _key_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    found = labs(spark, sf)
    return {
        Q.SPECTRA: spectra(spark, sf).select("SSN"),
        Q.CROPNUTS: found["cropnuts"].select("SSN"),
        Q.ICRAF: found["icraf"].select("SSN"),
        Q.RRES: found["rres"].select("SSN"),
    }


KEYS_SQL = f"""{LABS_SQL}, {SPECTRA_SQL},
all_keys as (select 'bronze_espectro' as tbl, ssn from spectra union all select 'wet_cropnuts', ssn from cropnuts
    union all select 'wet_icraf', ssn from icraf union all select 'wet_rres', ssn from rres),
wet as (select distinct ssn from all_keys where tbl <> 'bronze_espectro' and ssn is not null)"""


@query("silver_master", f"with {SILVER_SQL} select ssn, {TARGET_LIST}, {WIDE_SQL} from silver")
def silver_wide(spark: SparkSession, sf: str) -> DataFrame:
    return widen(silver(spark, sf), POINTS)


@query("silver_filtered_spectra", f"with {SILVER_SQL} select ssn, {TARGET_LIST}, {WIDE_SQL} from silver")
def silver_filtered_spectra(spark: SparkSession, sf: str) -> DataFrame:
    """Spectra that no laboratory measured are taken out before the join, as the Silver job does."""
    measured = labs(spark, sf)
    return widen(silver_master(with_lab_row(spectra(spark, sf), measured), measured), POINTS)


@query("key_blank_to_null", f"with {LABS_SQL} select c.ssn as clean_key, o.o_orderkey from orders o join (select "
       "o_orderkey, case when o_orderkey % 97 = 0 then null else concat('icr', lpad(cast(o_custkey as varchar), "
       "12, '0')) end as ssn from orders) c using (o_orderkey)")  # fmt: skip
def key_blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    raw = F.when(F.col("o_orderkey") % 97 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit("icr"), F.lpad(F.col("o_custkey").cast("string"), 12, "0"))
    )
    return orders.select("o_orderkey", blank_to_null(raw).alias("clean_key"))


@query(
    "wet_full_outer",
    f"""with {LABS_SQL},
    two as (select coalesce(r.ssn, i.ssn) as ssn, r.ph as r_ph, r.pct_c as r_c, r.ecec as r_ecec, i.ph as i_ph,
        i.pct_c as i_c, i.exbas as i_exbas from rres r full outer join icraf i on r.ssn = i.ssn)
    select coalesce(two.ssn, c.ssn) as ssn, r_ph, r_c, r_ecec, i_ph, i_c, i_exbas, c.pct_c as c_c,
        c.olsen as c_olsen, c.exbas as c_exbas from two full outer join cropnuts c on two.ssn = c.ssn""",
)
def wet_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    joined = lab_join(labs(spark, sf))
    names = {
        "rres:pH": "r_ph", "rres:%C": "r_c", "rres:ECEC cmolc/ kg soil": "r_ecec", "icraf:pH": "i_ph",
        "icraf:%C": "i_c", "icraf:ExBas": "i_exbas", "cropnuts:%C": "c_c", "cropnuts: Olsen P mg/kg": "c_olsen",
        "cropnuts:ExBas": "c_exbas",
    }
    return joined.select(F.col("SSN").alias("ssn"), *[F.col(f"`{old}`").alias(new) for old, new in names.items()])


@query(
    "targets_coalesced",
    f"""with {LABS_SQL},
    two as (select coalesce(r.ssn, i.ssn) as ssn, r.ph as rph, i.ph as iph, r.pct_c as rc, i.pct_c as ic,
        r.ecec as re, i.exbas as ix from rres r full outer join icraf i on r.ssn = i.ssn)
    select coalesce(two.ssn, c.ssn) as ssn, coalesce(rph, iph) as ph, coalesce(rc, ic, c.pct_c) as pct_c,
        c.olsen as olsen_p_mg_kg, re as ecec_cmolc__kg_soil, coalesce(ix, c.exbas) as exbas
    from two full outer join cropnuts c on two.ssn = c.ssn""",
)
def targets_coalesced(spark: SparkSession, sf: str) -> DataFrame:
    return coalesced_targets(labs(spark, sf)).toDF("ssn", *TARGETS)


@query(
    "dedup_by_key",
    f"""with {LABS_SQL}, numbered as (select *, row_number() over (partition by ssn order by pct_c nulls last,
        olsen nulls last, exbas nulls last) as rn from cropnuts)
    select ssn, pct_c, olsen, exbas from numbered where rn = 1""",
)
def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    cropnuts = labs(spark, sf)["cropnuts"].toDF("ssn", "pct_c", "olsen", "exbas")
    return first_per_key(cropnuts, ["ssn"], ["pct_c", "olsen", "exbas"])


@query(
    "silver_drop_lineage",
    f"with {SILVER_SQL} select ssn, {TARGET_LIST}, {WIDE_SQL} from silver",
)
def silver_drop_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Silver with all columns of the measurement files, without them again."""
    rows = silver(spark, sf)
    for name in LINEAGE_COLUMNS:
        rows = rows.withColumn(name, F.concat(F.lit(f"{name} of "), F.col(rows.columns[0])))
    return widen(rows.drop(*LINEAGE_COLUMNS), POINTS)


@query(
    "normalize_names",
    r"""with named as (select p_partkey, concat(' ', p_name, '/ %', p_brand, ' ', p_type, ' ') as raw from part)
    select p_partkey, regexp_replace(replace(replace(replace(lower(trim(raw)), '%', 'pct_'), '/', '_'), ' ', '_'),
        '[^a-z0-9_]', '', 'g') as name from named""",
)
def normalize_names(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(F.lit(" "), "p_name", F.lit("/ %"), "p_brand", F.lit(" "), "p_type", F.lit(" "))
    return table(spark, sf, "part").select("p_partkey", snake_name_of(raw).alias("name"))


@query(
    "spectral_columns",
    f"""with {SPECTRA_SQL}, long as (select unnest(spectrum) as x, unnest(range(len(spectrum))) as i from spectra)
    select concat('wn_', cast(i as varchar)) as column_name, count(x) as filled, min(x) as low, max(x) as high
    from long group by i""",
)
def spectral_columns_profile(spark: SparkSession, sf: str) -> DataFrame:
    long = lengthen(spectra(spark, sf), [])
    return long.groupBy("i").agg(F.count("x").alias("filled"), F.min("x").alias("low"), F.max("x").alias("high")).select(
        F.concat(F.lit("wn_"), F.col("i").cast("string")).alias("column_name"), "filled", "low", "high"
    )


@query("spectrum_to_wide", f"with {SPECTRA_SQL} select ssn, {WIDE_SQL} from spectra")
def spectrum_to_wide(spark: SparkSession, sf: str) -> DataFrame:
    return widen(spectra(spark, sf).select(F.col("SSN").alias("ssn"), "spectrum"), POINTS)


@query(
    "spectrum_to_long",
    f"with {SPECTRA_SQL} select ssn, unnest(range(len(spectrum))) as i, unnest(spectrum) as x from spectra",
)
def spectrum_to_long(spark: SparkSession, sf: str) -> DataFrame:
    long = lengthen(spectra(spark, sf).select(F.col("SSN").alias("ssn"), "spectrum"), ["ssn"])
    return long.withColumn("i", F.col("i").cast("bigint"))


@query("wet_keys_union", f"with {KEYS_SQL} select ssn from wet")
def wet_keys_union(spark: SparkSession, sf: str) -> DataFrame:
    a, b, c = (labs(spark, sf)[n].select(F.col("SSN").alias("ssn")) for n in ("cropnuts", "icraf", "rres"))
    return a.unionByName(b).unionByName(c).filter("ssn is not null").distinct()


@query("coverage_matched", f"with {KEYS_SQL} select ssn from wet where ssn in (select ssn from spectra)")
def coverage_matched(spark: SparkSession, sf: str) -> DataFrame:
    return wet_keys_union(spark, sf).join(spectra(spark, sf).select(F.col("SSN").alias("ssn")).distinct(), "ssn")


@query(
    "spectra_without_wet",
    f"with {KEYS_SQL} select distinct ssn from spectra s where not exists (select 1 from wet where wet.ssn = s.ssn)",
)
def spectra_without_wet(spark: SparkSession, sf: str) -> DataFrame:
    scanned = spectra(spark, sf).select(F.col("SSN").alias("ssn")).distinct()
    return scanned.join(wet_keys_union(spark, sf), "ssn", "left_anti")


@query("null_keys", f"with {KEYS_SQL} select tbl, count(*) filter (ssn is null) as null_keys from all_keys group by tbl")
def null_keys(spark: SparkSession, sf: str) -> DataFrame:
    tables = _key_tables(spark, sf)
    census = Q.key_census(tables)
    row = census.agg(*[F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col(t))), F.lit(0)).alias(t) for t in tables])
    return row.unpivot([], list(tables), "tbl", "null_keys")


@query(
    "duplicate_keys",
    f"""with {KEYS_SQL}, counted as (select tbl, ssn, count(*) as n from all_keys group by tbl, ssn)
    select tbl, count(*) filter (n > 1 and ssn is not null) as duplicated,
        count(*) filter (n > 1) as duplicated_with_null from counted group by tbl""",
)
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    tables = _key_tables(spark, sf)
    census = Q.key_census(tables)
    known = F.col("key").isNotNull()
    row = census.agg(
        F.array(
            *[
                F.struct(
                    F.lit(t).alias("tbl"),
                    F.count_if(known & (F.col(t) > 1)).alias("duplicated"),
                    F.count_if(F.col(t) > 1).alias("duplicated_with_null"),
                )
                for t in tables
            ]
        ).alias("rows")
    )
    return row.select(F.inline("rows"))


@query("distinct_keys", f"with {KEYS_SQL} select tbl, count(distinct ssn) as keys from all_keys group by tbl")
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    tables = _key_tables(spark, sf)
    census = Q.key_census(tables).filter("key is not null")
    return census.agg(*[F.count_if(F.col(t) > 0).alias(t) for t in tables]).unpivot([], list(tables), "tbl", "keys")


@query(
    "join_coverage",
    f"""with {KEYS_SQL}, s as (select distinct ssn from spectra), j as (select wet.ssn as w, s.ssn as s
        from wet full outer join s on wet.ssn = s.ssn)
    select count(w) as unique_wet, count(s) as unique_spectra, count(*) filter (w is not null and s is not null)
        as matched, count(*) filter (s is null) as wet_without, count(*) filter (w is null) as spectra_without,
        round((count(*) filter (w is not null and s is not null) / count(w)) * 100, 2) as pct from j""",
)
def join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    tables = _key_tables(spark, sf)
    row = Q.key_metrics(Q.key_census(tables), list(tables))
    return row.select(
        F.col(Q.UNIQUE_WET).alias("unique_wet"),
        F.col(Q.UNIQUE_SPECTRA).alias("unique_spectra"),
        F.col(Q.MATCHED).alias("matched"),
        F.col(Q.WET_ONLY).alias("wet_without"),
        F.col(Q.SPECTRA_ONLY).alias("spectra_without"),
        F.col(Q.COVERAGE).alias("pct"),
    )


@query(
    "target_fill",
    f"with {SILVER_SQL} "
    + " union all ".join(
        f"select '{t}' as target, count({t}) as filled, count(*) - count({t}) as missing from silver" for t in TARGETS
    ),
)
def target_fill(spark: SparkSession, sf: str) -> DataFrame:
    row = silver(spark, sf).agg(*Q.target_aggregates(TARGETS))
    parts = [
        F.struct(
            F.lit(t).alias("target"),
            F.col(Q.FILLED.format(t)).alias("filled"),
            F.col(Q.MISSING.format(t)).alias("missing"),
        )
        for t in TARGETS
    ]
    return row.select(F.inline(F.array(*parts)))


DOMAIN_SQL = {
    "ph": "ph < 0 or ph > 14",
    "pct_c": "pct_c < 0",
    "olsen_p_mg_kg": "olsen_p_mg_kg < 0",
    "ecec_cmolc__kg_soil": "ecec_cmolc__kg_soil < 0",
    "exbas": "exbas < 0",
}


@query(
    "domain_violations",
    f"with {SILVER_SQL} "
    + " union all ".join(
        f"select '{t}' as target, count(*) filter ({rule}) as violations from silver" for t, rule in DOMAIN_SQL.items()
    ),
)
def domain_violations(spark: SparkSession, sf: str) -> DataFrame:
    row = silver(spark, sf).agg(*[F.count_if(Q.outside_domain(t, F.col(t))).alias(t) for t in TARGETS])
    return row.unpivot([], TARGETS, "target", "violations")


@query(
    "spectral_nulls",
    f"with {SILVER_SQL} select coalesce(max(len(spectrum)), 0) as points, "
    + ", ".join(f"count(*) filter (spectrum[{i + 1}] is null) as wn_{i}" for i in range(10))
    + " from silver",
)
def spectral_nulls(spark: SparkSession, sf: str) -> DataFrame:
    row = silver(spark, sf).agg(*Q.spectral_aggregates())
    return row.toDF("points", *[f"wn_{i}" for i in range(10)])


@query(
    "silver_volumetry",
    f"""with {SILVER_SQL} select (select count(*) from spectra) as bronze_espectro,
    (select count(*) from cropnuts) as wet_cropnuts, (select count(*) from icraf) as wet_icraf,
    (select count(*) from rres) as wet_rres, count(*) as silver_final,
    cast(max(len(spectrum)) + 6 as bigint) as silver_columns from silver""",
)
def silver_volumetry(spark: SparkSession, sf: str) -> DataFrame:
    master = silver(spark, sf)
    parts = [t.select(F.lit(n).alias("tbl"), F.lit(0).alias("points")) for n, t in _key_tables(spark, sf).items()]
    rows = master.select(F.lit(Q.SILVER).alias("tbl"), F.coalesce(F.array_size("spectrum"), F.lit(0)).alias("points"))
    for part in parts:
        rows = rows.unionByName(part)
    names = [Q.SPECTRA, Q.CROPNUTS, Q.ICRAF, Q.RRES, Q.SILVER]
    width = F.max("points") + len(master.columns) - 1
    return rows.agg(
        *[F.count_if(F.col("tbl") == n).alias(n) for n in names], width.cast("bigint").alias("silver_columns")
    )


def _metric_sql() -> str:
    keys = []
    for t in ("bronze_espectro", "wet_cropnuts", "wet_icraf", "wet_rres"):
        keys += [
            f"select 'qtd_linhas_{t}' as metric_name, count(*) as v from all_keys where tbl = '{t}'",
            f"select 'qtd_ssn_nulo_{t}', count(*) from all_keys where tbl = '{t}' and ssn is null",
            f"select 'qtd_ssn_duplicado_{t}', count(*) from (select ssn from all_keys where tbl = '{t}' "
            "and ssn is not null group by ssn having count(*) > 1)",
        ]
    keys += [
        "select 'qtd_linhas_silver_final', count(*) from silver",
        "select 'qtd_ssn_duplicado_silver_final', count(*) from (select ssn from silver where ssn is not null "
        "group by ssn having count(*) > 1)",
        "select 'qtd_colunas_silver_final', max(len(spectrum)) + 6 from silver",
        "select 'qtd_colunas_espectrais_wn', max(len(spectrum)) from silver",
        "select 'qtd_ssn_unicos_wet_unificado', count(*) from wet",
        "select 'qtd_ssn_unicos_espectro', count(distinct ssn) from spectra",
        "select 'qtd_wet_com_match_espectro', count(*) from wet where ssn in (select ssn from spectra)",
        "select 'qtd_wet_sem_espectro', count(*) from wet where ssn not in (select ssn from spectra)",
        "select 'qtd_espectro_sem_wet', count(*) from spectra where ssn not in (select ssn from wet)",
    ]
    names = {t: f"qtd_{t}_negativo" for t in TARGETS} | {"ph": "qtd_ph_fora_faixa_0_14"}
    for t in TARGETS:
        keys += [
            f"select 'qtd_preenchido_{t}', count({t}) from silver",
            f"select 'qtd_nulo_{t}', count(*) from silver where {t} is null",
            f"select '{names[t]}', count(*) from silver where {DOMAIN_SQL[t]}",
        ]
    keys += [f"select 'qtd_nulo_wn_{i}', count(*) from silver where spectrum[{i + 1}] is null" for i in range(10)]
    counts = " union all ".join(keys)
    extra = KEYS_SQL.split(f"{SPECTRA_SQL},", 1)[1]
    return f"""with {SILVER_SQL}, {extra}, counts as ({counts})
    select metric_name, cast(v as varchar) as metric_value, cast(v as double) as numeric_value from counts union all
    select 'pct_cobertura_wet_com_espectro', cast(pct as varchar), pct from (select round((count(*) filter
    (ssn in (select ssn from spectra)) / count(*)) * 100, 2) as pct from wet)"""


@query("silver_metrics", _metric_sql())
def silver_metrics(spark: SparkSession, sf: str) -> DataFrame:
    master = materialise(silver(spark, sf), "silver")
    return Q.silver_metrics(_key_tables(spark, sf), master)


@query("audit_csv_roundtrip", f"select metric_name, numeric_value as metric_value from ({_metric_sql()})")
def audit_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """All 47 metrics of Silver through the report; what comes back is text, compared as numbers."""
    report = silver_metrics(spark, sf).select("metric_name", "metric_value")
    path = write_report(report, fresh_path(spark, "validations"), "2024-01-01-00-00")
    back = read_report(spark, path, "metric_name string, metric_value string")
    return back.select("metric_name", F.col("metric_value").cast("double").alias("metric_value"))


@query("preview_keys", f"with {SPECTRA_SQL} select ssn, concat(ssn, '.0') as file_name from spectra order by ssn limit 10")
def preview_keys(spark: SparkSession, sf: str) -> DataFrame:
    named = spectra(spark, sf).select(F.col("SSN").alias("ssn"), F.substring_index("source", "/", -1).alias("file_name"))
    return named.orderBy("ssn").limit(10)


@query("silver_write_read", f"with {SILVER_SQL} select ssn, {TARGET_LIST}, {WIDE_SQL} from silver")
def silver_write_read(spark: SparkSession, sf: str) -> DataFrame:
    path, used = write_silver(silver(spark, sf))
    return widen(spark.read.format(used).load(path), POINTS)


@query("silver_csv_fallback", f"with {SILVER_SQL} select ssn, {TARGET_LIST}, {WIDE_SQL} from silver")
def silver_csv_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Silver where Parquet cannot be written (a codec that is not installed): the CSV it leaves, read back."""
    codec = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(codec)
    spark.conf.set(codec, "lzo")
    try:
        path, used = write_silver(silver(spark, sf), points=POINTS)
    finally:
        spark.conf.set(codec, before)
    if used != "csv":
        raise RuntimeError(f"expected CSV, Silver was saved as {used}")
    columns = ["ssn string", *[f"{t} double" for t in TARGETS], *[f"wn_{i} double" for i in range(POINTS)]]
    return read_report(spark, path, ", ".join(columns))


GUARDED = ["benchmark", "conversations", "documents", "events", "labels", "pages"]


@query(
    "key_column_guard",
    " union all ".join(
        f"select '{t}' as table_name, count(*) as table_rows, count(case when trim(text) <> '' then 1 end) as clean_keys, "
        f"null as message from {t}" for t in ("benchmark", "conversations", "documents")
    )
    + "".join(
        f" union all select '{t}', count(*), null, 'table ''{t}'' has no key column ''text''' from {t}"
        for t in ("events", "labels", "pages")
    ),
)
def key_column_guard(spark: SparkSession, sf: str) -> DataFrame:
    """Tables asked for a key column: how many keys it holds, or what the guard says of a table without one."""
    parts = []
    for name in GUARDED:
        rows, keys, message = table(spark, sf, name), F.lit(None), F.lit(None)
        try:
            rows = with_clean_key(rows, name, "text")
            keys = F.count("text")
        except KeyError as error:
            message = F.lit(error.args[0])
        parts.append(rows.agg(
            F.lit(name).alias("table_name"), F.count("*").alias("table_rows"),
            keys.cast("long").alias("clean_keys"), message.cast("string").alias("message"),
        ))
    return reduce(DataFrame.unionByName, parts)


@query(
    "schema_report",
    f"with {SILVER_SQL} select 'ssn' as column_name, 'string' as type, count(ssn) as filled from silver union all "
    + " union all ".join(f"select '{t}', 'double', count({t}) from silver" for t in TARGETS)
    + " union all select 'spectrum', 'array<double>', count(spectrum) from silver",
)
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    master = silver(spark, sf)
    counts = master.agg(*[F.count(c).alias(c) for c in master.columns])
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("filled"),
        )
        for f in master.schema.fields
    ]
    return counts.select(F.inline(F.array(*rows)))



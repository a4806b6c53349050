"""Listing, copying and decoding queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.keys import file_name, sample_id, sample_key, uri_bucket, uri_key
from edaphon.queries.registry import query
from edaphon.queries.views import (
    LABS_SQL,
    OBJECTS_SQL,
    POINTS,
    PREFIX_SQL,
    PREFIXES,
    SILVER_SQL,
    objects,
    raw_labs,
    silver,
    ssn,
    table,
)
from edaphon.session import fresh_path
from edaphon.operators import quality as Q
from edaphon.sinks.copy import copy_audit, copy_counters, copy_objects, put_objects
from edaphon.sinks.lake import read_report, write_report
from edaphon.sources import manifest as M
from edaphon.sources.lab_tables import read_lab_csv
from edaphon.sources.spectra import decode, decode_status, is_spectrum_key, scan_spectra, spectra_base

RUN = {"execution_utc": "2024-01-01 00:00:00", "source_bucket": "pages", "dest_bucket": "lake"}
DEST = "bronze/"


def page_objects(spark: SparkSession, sf: str) -> DataFrame:
    """``(key, content)``: every page as an object, one flat folder per language; some are empty."""
    lang = F.regexp_extract("url", "^https?://[^/]+/([a-z]+)", 1)
    key = F.concat(lang, F.lit("/"), F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit(".html"))
    html = F.when(F.col("page_id") % 50 == 7, "").otherwise(F.col("html"))
    return table(spark, sf, "pages").select("page_id", key.alias("key"), F.encode(html, "utf-8").alias("content"))


def page_files(spark: SparkSession, sf: str) -> str:
    """A folder with the pages as files, written by tasks."""
    root = fresh_path(spark, "pages")
    put_objects(page_objects(spark, sf), root)
    return root


PAGE_OBJECTS_SQL = r"""
page_objects as (select page_id, concat(regexp_extract(url, '^https?://[^/]+/([a-z]+)', 1), '/',
    lpad(cast(page_id as varchar), 8, '0'), '.html') as key, case when page_id % 50 = 7 then '' else html end as html,
    cast(case when page_id % 50 = 7 then 0 else strlen(html) end as bigint) as size from pages)"""


@query("bronze_manifest", f"with {PAGE_OBJECTS_SQL} select key, size from page_objects")
def bronze_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The pages written as files and listed again."""
    return M.object_manifest(spark, page_files(spark, sf))


@query(
    "bronze_manifest_prefixes",
    f"with {PAGE_OBJECTS_SQL} select key, size from page_objects where key like 'en/0%' or key like 'fr/%'",
)
def bronze_manifest_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping prefixes, part of a name and one that holds nothing."""
    return M.object_manifest(spark, page_files(spark, sf), ["en/0", "en/00", "fr/", "zz/none/"])


@query(
    "spectra_scan",
    f"""with {PAGE_OBJECTS_SQL} select key as source, size as bytes, md5(html) as digest from page_objects
    where starts_with(key, 'en/')""",
)
def spectra_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The contents of the listed files, read by planned groups; empty files are rows."""
    root = page_files(spark, sf)
    files = scan_spectra(spark, root, "/en/", r"\.html$")
    source = F.substring("source", len(root) + 2, 1 << 20)
    return files.select(source.alias("source"), F.length("content").cast("bigint").alias("bytes"), F.md5("content").alias("digest"))


@query(
    "bronze_copy_pages",
    f"""with {PAGE_OBJECTS_SQL}, listed as (select prefix, page_id, key, size from {PREFIX_SQL}
        left join page_objects on starts_with(key, prefix))
    select prefix, key as source_key, '{DEST}' || key as dest_key, size as source_size,
        case when page_id % 10 = 3 then 3 else size end as dest_size,
        case when key is null then 'empty_prefix' when page_id % 10 = 3 then 'skipped_existing' else 'copied' end as status,
        case when key is null then 'Nenhum arquivo encontrado para o prefix.' else '' end as error_message
    from listed""",
)
def bronze_copy_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Copies the pages' files to a folder where some of them are already, with other contents."""
    root, target = page_files(spark, sf), fresh_path(spark, "bronze")
    there = page_objects(spark, sf).filter("page_id % 10 = 3").select(F.concat(F.lit(DEST), "key").alias("key"), F.encode(F.lit("old"), "utf-8").alias("content"))
    put_objects(there, target)
    audit = copy_objects(M.object_manifest(spark, root), M.object_manifest(spark, target), root, target, PREFIXES, DEST, RUN)
    return audit.select("prefix", "source_key", "dest_key", "source_size", "dest_size", "status", "error_message")


@query(
    "object_manifest",
    f"with {OBJECTS_SQL} select key, size from objects where right(key, 1) <> '/'",
)
def object_listing(spark: SparkSession, sf: str) -> DataFrame:
    return M.without_folders(objects(spark, sf)).select("key", "size")


@query(
    "bronze_prefix_counts",
    f"""with {OBJECTS_SQL} select prefix, count(key) as objects, coalesce(sum(size), 0)::bigint as bytes,
    count(*) filter (size = 0) as zero_byte from {PREFIX_SQL} left join objects
    on starts_with(key, prefix) and right(key, 1) <> '/' group by prefix""",
)
def bronze_prefix_counts(spark: SparkSession, sf: str) -> DataFrame:
    return M.prefix_counts(objects(spark, sf), PREFIXES)


def _destination(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The destination before and after a run. Pages served by https were there before, the mobile
    hosts' could not be copied, and some arrived with another size."""
    found = M.without_folders(objects(spark, sf)).withColumn("key", F.concat(F.lit(DEST), "key"))
    url = F.col("url")
    there, mobile = url.startswith("https:"), url.contains("://m.")
    grown = F.when(url.contains("ref="), F.col("size") + 1).otherwise(F.col("size"))
    sized = found.select("key", grown.alias("size"), there.alias("there"), mobile.alias("mobile"))
    before = sized.filter("there").select("key", "size")
    after = sized.filter("there or not mobile").select("key", "size")
    return before, after


AUDIT_SQL = f"""{OBJECTS_SQL},
source as (select * from objects where right(key, 1) <> '/'),
dest as (select url, starts_with(url, 'https:') as earlier, starts_with(url, 'https:') or not contains(url, '://m.')
    as later, size + case when contains(url, 'ref=') then 1 else 0 end as size from source),
judged as (select prefix, s.key as source_key, s.size as source_size, concat('{DEST}', s.key) as dest_key,
    case when earlier or later then d.size end as dest_size,
    case when s.key is null then 'empty_prefix' when earlier then 'skipped_existing' when not later then 'failed'
    when d.size <> s.size then 'copied_with_size_mismatch' else 'copied' end as status
    from {PREFIX_SQL} left join source s on starts_with(s.key, prefix) left join dest d using (url)),
audit as (select '{RUN["execution_utc"]}' as execution_utc, prefix, '{RUN["source_bucket"]}' as source_bucket,
    source_key, '{RUN["dest_bucket"]}' as dest_bucket, case when source_key is not null then dest_key end as dest_key,
    source_size, dest_size, status, case status when 'empty_prefix' then 'Nenhum arquivo encontrado para o prefix.'
    when 'failed' then concat('Objeto não encontrado no destino após upload: ', dest_key)
    when 'copied_with_size_mismatch' then 'Tamanho no destino diferente do tamanho da origem.' else '' end
    as error_message from judged)"""


@query("bronze_copy_audit", f"with {AUDIT_SQL} select * from audit")
def bronze_copy_audit(spark: SparkSession, sf: str) -> DataFrame:
    before, after = _destination(spark, sf)
    return copy_audit(objects(spark, sf), before, after, PREFIXES, DEST, RUN)


@query(
    "bronze_counters",
    f"""with {AUDIT_SQL} select prefix, count(source_key) as found,
    count(*) filter (status in ('copied', 'copied_with_size_mismatch')) as copied,
    count(*) filter (status = 'skipped_existing') as skipped, count(*) filter (status = 'failed') as failed,
    count(*) filter (source_size = 0) as zero_byte,
    count(*) filter (status = 'copied_with_size_mismatch') as size_mismatch from audit group by rollup (prefix)""",
)
def bronze_counters(spark: SparkSession, sf: str) -> DataFrame:
    return copy_counters(bronze_copy_audit(spark, sf))


@query("bronze_copy")
def bronze_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Copies the files of the spectra and laboratory tables; one prefix holds nothing."""
    prefixes = ["embeddings", "part", "customer", "orders", "zz/none/"]
    source = M.object_manifest(spark, sf, prefixes)
    target = fresh_path(spark, "bronze")
    before = M.object_manifest(spark, target)
    audit = copy_objects(source, before, sf, target, prefixes, DEST, RUN)
    return audit.select("prefix", "source_key", "dest_key", "source_size", "dest_size", "status", "error_message")


@query(
    "source_lookup",
    f"""with {OBJECTS_SQL}, wanted as (select * from (values ('0.html'), ('.html'), ('/1'), ('.missing')) w(suffix))
    select suffix, min(key) as key from wanted left join objects on ends_with(key, suffix) and right(key, 1) <> '/'
    group by suffix""",
)
def source_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return M.keys_by_suffix(objects(spark, sf), ["0.html", ".html", "/1", ".missing"])


@query(
    "spectra_key_filter",
    r"""select url from pages where contains(url, '/en/') and regexp_matches(url, '\.html$') and right(url, 1) <> '/'""",
)
def spectra_key_filter(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("url").filter(is_spectrum_key(F.col("url"), "/en/", r"\.html$"))


def raw_files(spark: SparkSession, sf: str) -> DataFrame:
    """``(source, content)``: a measurement file per embedding. Label 7 lacks the spectrum block,
    label 8 is damaged, label 3 was measured twice."""
    name = F.concat(ssn(F.col("vec_id")), F.lit(".0"))
    folders = F.when(F.col("label") == 3, F.array(F.lit("first/"), F.lit("again/"))).otherwise(F.array(F.lit("first/")))
    values = F.concat_ws(",", F.col("embedding").cast("array<double>").cast("array<string>"))
    text = (
        F.when(F.col("label") == 7, F.concat(F.lit("SC:"), values))
        .when(F.col("label") == 8, F.concat(F.lit("AB:x"), values))
        .otherwise(F.concat(F.lit("AB:"), values))
    )
    spread = table(spark, sf, "embeddings").withColumn("folder", F.explode(folders))
    source = F.concat(F.lit("lake/"), "folder", F.lit("Bruker_Alpha_KBr/"), name)
    return spread.select(source.alias("source"), F.encode(text, "utf-8").alias("content")).filter(
        is_spectrum_key(F.col("source"))
    )


@query(
    "spectra_base",
    """with rows as (select lpad(cast(vec_id as varchar), 12, '0') as sample_id, label, embedding from embeddings
        where label not in (7, 8))
    select concat('icr', sample_id) as ssn, sample_id, concat('icr', sample_id, '.0') as file_name,
        concat('lake/', case when label = 3 then 'again' else 'first' end, '/Bruker_Alpha_KBr/icr', sample_id, '.0')
        as source, """
    + ", ".join(f"cast(embedding[{i + 1}] as double) as wn_{i}" for i in range(POINTS))
    + ", len(embedding) as points from rows",
)
def spectra_base_query(spark: SparkSession, sf: str) -> DataFrame:
    base = spectra_base(decode(raw_files(spark, sf)))
    ends = [F.get("spectrum", F.lit(i)).alias(f"wn_{i}") for i in range(POINTS)]
    points = F.size("spectrum").cast("bigint").alias("points")
    return base.select(F.col("SSN").alias("ssn"), "sample_id", "file_name", "source", *ends, points)


@query(
    "spectra_decode_status",
    """select case label when 7 then 'no_spectrum' when 8 then 'error' else 'ok' end as decode_status,
    cast(sum(case when label = 3 then 2 else 1 end) as bigint) as files from embeddings group by 1""",
)
def spectra_decode_status(spark: SparkSession, sf: str) -> DataFrame:
    return decode_status(decode(raw_files(spark, sf)))


@query(
    "sample_id_from_path",
    r"""with named as (select url, regexp_extract(url, '([^/]*)/*$', 1) as name from pages),
    stems as (select url, name, regexp_replace(name, '^(.+)\.[^.]+$', '\1') as stem from named)
    select url, name as file_name, trim(replace(stem, 'icr', '')) as sample_id,
    concat('icr', trim(replace(stem, 'icr', ''))) as ssn from stems""",
)
def sample_id_from_path(spark: SparkSession, sf: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "url", file_name(url).alias("file_name"), sample_id(url).alias("sample_id"), sample_key(url).alias("ssn")
    )


@query(
    "uri_parts",
    r"""select url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) as bucket,
    ltrim(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') as key from pages""",
)
def uri_parts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("url", uri_bucket(F.col("url")).alias("bucket"), uri_key(F.col("url")).alias("key"))


@query(
    "scalar_suite",
    """select event_id, coalesce(nullif(event_type, 'click'), 'none') as kind, cast(user_id as varchar) as user_text,
    round(value, 2) as value_2, sqrt(abs(value)) as root, value / (user_id + 1) as ratio,
    strftime(ts, '%Y-%m-%d-%H-%M') as stamp, case when value > 10 then 'high' end as high from events""",
)
def scalar_suite(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    kind = F.when(F.col("event_type") != "click", F.col("event_type"))
    return table(spark, sf, "events").select(
        "event_id",
        F.coalesce(kind, F.lit("none")).alias("kind"),
        F.col("user_id").cast("string").alias("user_text"),
        F.round(value, 2).alias("value_2"),
        F.sqrt(F.abs(value)).alias("root"),
        (value / (F.col("user_id") + 1)).alias("ratio"),
        F.date_format("ts", "yyyy-MM-dd-HH-mm").alias("stamp"),
        F.when(value > 10, "high").alias("high"),
    )


@query("csv_roundtrip", f"with {LABS_SQL} select ssn, pct_c, olsen, exbas from cropnuts")
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A laboratory table through CSV, as the laboratories deliver it."""
    path = fresh_path(spark, "lab-csv")
    # the header of one column starts with a blank, and some keys are blanks only
    raw_labs(spark, sf)["cropnuts"].write.options(
        header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
    return read_lab_csv(spark, path, "cropnuts").toDF("ssn", "pct_c", "olsen", "exbas")

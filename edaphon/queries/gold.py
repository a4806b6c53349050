"""Gold tables and their audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edaphon.functions.spectrum import widen
from edaphon.operators.gold import GOLD_TARGETS, gold_audit, gold_table, gold_tidy
from edaphon.queries.registry import query
from edaphon.queries.views import GOLD_SQL, POINTS, SILVER_SQL, WIDE_SQL, gold, silver
from edaphon.session import fresh_path
from edaphon.sinks.lake import gold_of, output_size, read_gold, write_gold


def _register(name: str, target: str) -> None:
    sql = f"""with {SILVER_SQL} select ssn, {target}, {WIDE_SQL} from silver
    where ssn is not null and {target} is not null and spectrum is not null"""

    @query(f"gold_{name}", sql)
    def gold_wide(spark: SparkSession, sf: str) -> DataFrame:
        return widen(gold_table(silver(spark, sf), target, POINTS), POINTS)


for _name, _target in GOLD_TARGETS.items():
    _register(_name, _target)


@query(
    "gold_select",
    f"with {SILVER_SQL} select ssn, ph, {WIDE_SQL} from silver",
)
def gold_select(spark: SparkSession, sf: str) -> DataFrame:
    return widen(silver(spark, sf).select("ssn", "ph", "spectrum"), POINTS)


def _audit_sql(with_: str = GOLD_SQL, silver: str = "silver", absent: tuple[str, ...] = ()) -> str:
    bad = {"ph": "y < 0 or y > 14", "ecec": "false"}
    parts = []
    for name, target in GOLD_TARGETS.items():
        if name in absent:
            parts.append(f"select '{name}', '{target}', 0, 0, 0, 0, 0")
            continue
        rows = f"select * from gold where target = '{name}'"
        parts.append(
            f"""select '{name}' as gold_name, '{target}' as target_col, (select count(*) from {silver}) as input_rows,
            (select count(*) from ({rows})) as output_rows,
            (select count(*) from {silver} where {target} is null) as null_target_rows,
            (select count(*) from (select ssn from ({rows}) group by ssn having count(*) > 1)) as duplicate_ssn,
            (select count(*) from ({rows}) where {bad.get(name, "y < 0")}) as invalid_target_rows"""
        )
    gone = ", ".join(f"'{name}'" for name in ("", *absent))
    return f"""with {with_}, counts as ({" union all ".join(parts)})
    select gold_name, target_col, input_rows, output_rows, input_rows - output_rows as dropped_rows,
    coalesce(round(((input_rows - output_rows) / nullif(input_rows, 0)) * 100, 2), 0e0) as pct_rows_dropped, null_target_rows, duplicate_ssn,
    invalid_target_rows, cast({POINTS} as bigint) as spectral_cols,
    case when gold_name in ({gone}) then 'failed' when output_rows = 0 then 'empty_gold_after_dropna' when duplicate_ssn > 0 then 'success_with_duplicates'
    when invalid_target_rows > 0 then 'success_with_invalid_target' else 'success' end as status,
    case when gold_name in ({gone}) then concat('Target ', target_col, ' não existe') else '' end as error_message from counts"""


@query("gold_audit", _audit_sql())
def gold_audit_query(spark: SparkSession, sf: str) -> DataFrame:
    return gold_audit(silver(spark, sf), POINTS)


# Silver with what a bad run leaves: samples twice, a target without values, one without a column, points missing
ROUGH_SQL = f"""{SILVER_SQL},
rough as (select ssn, ph, pct_c, olsen_p_mg_kg, cast(null as double) as ecec_cmolc__kg_soil, spectrum from silver union all
    select ssn, ph, null, null, null, spectrum from silver where ph is not null and right(ssn, 1) = '6'),
tidy as (select 'ph' as target, ssn, ph as y, spectrum from rough union all
    select 'carbono', ssn, pct_c, spectrum from rough union all select 'p', ssn, olsen_p_mg_kg, spectrum from rough),
gold as (select * from tidy where ssn is not null and y is not null and spectrum is not null
    and right(ssn, 1) not in ('1', '2', '8'))"""


def rough_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Spectra of keys that end in 1 hold a NaN, in 2 a NULL, in 8 a point too few; keys that end in 6 stand twice."""
    plain, last = silver(spark, sf).drop("exbas"), F.right("ssn", F.lit(1))
    points = F.col("spectrum")
    first = F.slice(points, 1, POINTS - 1)
    holed = (
        F.when(last == "1", F.concat(first, F.array(F.lit(float("nan")))))
        .when(last == "2", F.concat(first, F.array(F.lit(None).cast("double"))))
        .when(last == "8", first)
        .otherwise(points)
    )
    rows = plain.withColumn("spectrum", holed).withColumn("ecec_cmolc__kg_soil", F.lit(None).cast("double"))
    twice = rows.filter(F.col("ph").isNotNull() & (last == "6"))
    gone = F.lit(None).cast("double")
    return rows.unionByName(twice.withColumn("pct_c", gone).withColumn("olsen_p_mg_kg", gone))


@query("gold_audit_statuses", _audit_sql(ROUGH_SQL, "rough", ("exbas",)))
def gold_audit_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of a Silver that reaches every status."""
    return gold_audit(rough_silver(spark, sf), POINTS)


@query("gold_missing_points", f"with {ROUGH_SQL} select target, ssn, y, {WIDE_SQL} from gold")
def gold_missing_points(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows of that Silver: NULL, NaN and absent points leave no row."""
    return widen(gold_tidy(rough_silver(spark, sf), POINTS), POINTS)


def _written(spark: SparkSession, sf: str) -> str:
    return write_gold(gold(spark, sf), fresh_path(spark, "gold"))


@query("gold_write_read", f"with {GOLD_SQL} select target, ssn, y, {WIDE_SQL} from gold")
def gold_write_read(spark: SparkSession, sf: str) -> DataFrame:
    path = _written(spark, sf)
    # a second run of one target replaces that target and no other
    write_gold(gold(spark, sf).filter(F.col("target") == "ph"), path)
    return widen(read_gold(spark, path).select("target", "ssn", "y", "spectrum"), POINTS)


@query("gold_read_back", f"with {GOLD_SQL} select ssn, y as pct_c, {WIDE_SQL} from gold where target = 'carbono'")
def gold_read_back(spark: SparkSession, sf: str) -> DataFrame:
    return gold_of(read_gold(spark, _written(spark, sf)), "carbono", "pct_c", POINTS)


@query("gold_output_size")
def gold_output_size(spark: SparkSession, sf: str) -> DataFrame:
    return output_size(spark, _written(spark, sf))


@query(
    "gold_files_checked",
    f"with {GOLD_SQL} select target, true as has_files, true as files_agree, true as bytes_agree, count(*) as read_rows from gold group by target",
)
def gold_files_checked(spark: SparkSession, sf: str) -> DataFrame:
    """The listing's files and bytes of every target against those that a scan of the table meets."""
    path = _written(spark, sf)
    rows = read_gold(spark, path).groupBy("target", F.col("_metadata.file_path"), F.col("_metadata.file_size"))
    met = rows.agg(F.count("*").alias("n")).groupBy("target").agg(
        F.count("*").alias("met_files"), F.sum("file_size").alias("met_bytes"), F.sum("n").alias("read_rows")
    )
    both = output_size(spark, path).join(met, "target", "full")
    return both.select(
        "target", F.coalesce(F.col("files") > 0, F.lit(False)).alias("has_files"),
        F.col("files").eqNullSafe(F.col("met_files")).alias("files_agree"),
        F.col("bytes").eqNullSafe(F.col("met_bytes")).alias("bytes_agree"), "read_rows",
    )

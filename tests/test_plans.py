"""What the plans must look like, whatever the size of the tables."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
ITERATIVE = {"evaluate_models", "evaluate_all_targets", "refit_predict", "mlp_fit", "gbt_fit_depthwise",
             "gbt_fit_leafwise_space", "leaderboard", "leaderboard_csv_roundtrip", "bronze_copy", "pls_fit"}


@pytest.fixture
def shuffling(spark):
    """Plans as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


def plan_of(frame) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain("simple")
    return re.sub(r"#\d+L?", "", out.getvalue())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ITERATIVE))
def test_no_pairs(name, shuffling, sf):
    plan = plan_of(QUERIES[name](shuffling, sf))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_silver_moves_each_side_once(shuffling, sf):
    plan = plan_of(QUERIES["silver_master"](shuffling, sf))
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_min" in plan


def test_unmeasured_spectra_leave_before_they_move(shuffling, sf):
    plan = plan_of(QUERIES["silver_filtered_spectra"](shuffling, sf))
    lines = plan.split("\n")
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line and "BroadcastHashJoin" in line)
    depth = lines[semi].index("BroadcastHashJoin")
    above = [line for line in lines[:semi] if "Exchange hashpartitioning" in line and line.index("Exchange") < depth]
    assert above  # the exchange of the join lies over the filter
    below = lines[semi + 1 : next(i for i in range(semi + 1, len(lines)) if "BroadcastExchange" in lines[i])]
    assert not any("Exchange" in line for line in below)  # and none under it on the side of the spectra


def test_one_row_per_key_is_cut_before_the_shuffle(shuffling, sf):
    plan = plan_of(QUERIES["dedup_by_key"](shuffling, sf))
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]


def test_key_metrics_are_one_shuffle(shuffling, sf):
    plan = plan_of(QUERIES["join_coverage"](shuffling, sf))
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_full_outer_shuffles_each_table_once(shuffling, sf):
    plan = plan_of(QUERIES["wet_full_outer"](shuffling, sf))
    assert plan.count("FullOuter") == 2 and plan.count("FileScan") == 3
    assert plan.count("Exchange hashpartitioning") == 4


def test_gold_audit_is_one_pass(shuffling, sf):
    plan = plan_of(QUERIES["gold_audit"](shuffling, sf))
    assert plan.count("FileScan") == 4 and plan.count("Exchange SinglePartition") == 1


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("split_hash", {"vec_id"}),
        ("residual_bins", {"l_partkey", "l_quantity", "l_extendedprice", "p_partkey", "p_brand", "p_retailprice"}),
        ("uri_parts", {"url"}),
        ("join_coverage", {"p_partkey", "c_custkey", "o_orderkey", "o_custkey", "vec_id"}),
    ],
)
def test_scans_read_what_is_used(name, columns, shuffling, sf):
    plan = plan_of(QUERIES[name](shuffling, sf))
    read = {c for part in re.findall(r"FileScan parquet \[([^\]]*)\]", plan) for c in part.split(",")}
    assert read == columns


def test_windows_of_a_study_share_one_shuffle(shuffling, sf):
    plan = plan_of(QUERIES["best_trial"](shuffling, sf))
    assert plan.count("Exchange hashpartitioning") == 2  # the mean per cell, the study


def test_gold_filter_reads_one_folder(spark, sf, tmp_path):
    from edaphon.queries.views import gold
    from edaphon.sinks.lake import gold_of, read_gold, write_gold

    path = write_gold(gold(spark, sf), str(tmp_path / "gold"))
    plan = plan_of(gold_of(read_gold(spark, path), "ph", "ph").select("ph"))
    assert "PartitionFilters: [isnotnull(target), (target = ph)]" in plan
    assert "ReadSchema: struct<y:double>" in plan

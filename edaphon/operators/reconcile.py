"""Several laboratories, one row per sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.functions.keys import blank_to_null, with_snake_names
from edaphon.operators.quality import key_census
from edaphon.session import materialise
from edaphon.sources.lab_tables import KEY, LAB_TARGETS

# Columns that describe a measurement file and do not reach Silver.
LINEAGE_COLUMNS = [
    "sample_id", "file_name", "sample_name_param", "instrument", "resolution", "scans", "source",
    "experiment", "product", "product_group", "fd1", "wn_min", "wn_max", "n_points",
]


#: Buckets of the key filter before the spectra move; at most as many numbers are broadcast (8 bytes each, some 64 MB in all).
FILTER_BUCKETS = 1 << 21
#: Rows of one key that a task may read or join. What a key exceeds it by, on either side or in the product of both,
#: is dealt to more tasks, however many that takes.
HOT_ROWS = 1_000_000


def hot_cells(counts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``(_hot, _cut_l, _cut_r, _both)`` for the keys to spread, from ``(key, n_left, n_right)``.

    The rows of a key form a grid: its left rows cut into ``_cut_l`` chunks, its right rows into
    ``_cut_r``, a task per cell. A cell joins at most about ``hot_rows`` pairs, so the copies this
    takes are a small part of the pairs themselves.
    """
    most, n_l, n_r = float(max(hot_rows, 1)), F.col("n_left").cast("double"), F.col("n_right").cast("double")
    other_l, other_r = F.greatest(n_r, F.lit(1.0)), F.greatest(n_l, F.lit(1.0))
    side = F.lit(most**0.5)

    def cuts(rows: Column, others: Column) -> Column:
        return F.greatest(F.ceil(rows / F.greatest(side, F.lit(most) / others)), F.lit(1)).cast("int")

    return counts.filter(F.col("key").isNotNull() & (other_l * other_r > hot_rows)).select(
        F.col("key").alias("_hot"), cuts(n_l, other_l).alias("_cut_l"), cuts(n_r, other_r).alias("_cut_r"),
        ((n_l > 0) & (n_r > 0)).alias("_both"),
    )


def full_outer(left: DataFrame, right: DataFrame, key: str = KEY, hot: DataFrame | None = None) -> DataFrame:
    """Full outer join on ``key``, every row kept and duplicates multiplied.

    Rows without a key match nothing, so each side's are spread over cells the other side does not
    have. The rows of a key in ``hot`` (``hot_cells``) are dealt to the chunks of their side by a
    digest of the row and repeated for every chunk of the other side. A key that both sides have
    leaves no row unmatched, so what finds no partner in its cell is a leftover of the spreading and
    is dropped. The table of hot keys is as long as the output has multiples of ``hot_rows``; Spark
    joins it as it joins any other. Columns other than the key must have different names on the sides.
    """

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        k, spread = F.col(key), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
        # rows without a key: cells below zero, left and right apart
        without = -F.pmod(spread, F.lit(1024)).cast("int") * 2 - (1 if own == "l" else 2)
        none, zero = k.isNull(), F.lit(0)
        named = df.withColumn("_spread", spread)
        if hot is None:
            named = named.withColumns({"_chunk": F.when(none, without).otherwise(zero), "_copy": zero, f"_both_{own}": F.lit(False)})
        else:
            named = named.join(hot, k == F.col("_hot"), "left")
            spread_out = F.pmod(F.col("_spread"), F.col(f"_cut_{own}")).cast("int")
            copies = F.sequence(zero, F.coalesce(f"_cut_{other}", F.lit(1)) - 1)
            named = named.withColumns(
                {
                    "_chunk": F.when(none, without).otherwise(F.coalesce(spread_out, zero)),
                    "_copy": F.explode(copies),
                    f"_both_{own}": F.coalesce("_both", F.lit(False)),
                }
            )
        cell = ("_chunk", "_copy") if own == "l" else ("_copy", "_chunk")
        # both parts of the cell are below zero without a key, whichever side
        cells = [F.when(none, without).otherwise(F.col(c)).alias(f"_cell{i}") for i, c in enumerate(cell)]
        rest = [F.col(f"`{c}`") for c in df.columns if c != key]
        return named.select(F.coalesce(k, F.lit("")).alias("_on"), *cells, k.alias(f"_key_{own}"), f"_both_{own}", *rest)

    joined = dealt(left, "l", "r").join(dealt(right, "r", "l"), ["_on", "_cell0", "_cell1"], "full_outer")
    if hot is not None:
        alone = F.col("_both_l").isNull() | F.col("_both_r").isNull()
        joined = joined.filter(~(alone & F.coalesce("_both_l", "_both_r")))
    rest = [c for c in (*left.columns, *right.columns) if c != key]
    return joined.select(F.coalesce("_key_l", "_key_r").alias(key), *[F.col(f"`{c}`") for c in rest])


def present_targets(labs: list[DataFrame], targets: list[str] = LAB_TARGETS) -> list[str]:
    """The targets at least one laboratory measured, in the fixed order."""
    return [t for t in targets if any(t in lab.columns for lab in labs)]


def lab_join(labs: dict[str, DataFrame], targets: list[str] = LAB_TARGETS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The laboratories side by side, columns prefixed by laboratory, one row per combination.

    One count per key and table tells how many rows each join makes of a key, so a key that is
    moderate everywhere but large as a product is spread like one that is large in a table.
    """
    census = materialise(key_census(labs, KEY), "lab-keys")
    joined, rows, names = None, None, []
    for name, lab in labs.items():
        kept = [t for t in targets if t in lab.columns]
        renamed = lab.select(KEY, *[F.col(f"`{t}`").alias(f"{name}:{t}") for t in kept])
        names += renamed.columns[1:]
        own = F.col(f"`{name}`").cast("double")
        if joined is None:
            joined, rows = renamed, own
            continue
        cells = materialise(hot_cells(census.select("key", own.alias("n_left"), rows.alias("n_right")), hot_rows), "hot-keys")
        joined = full_outer(renamed, joined, KEY, None if cells.isEmpty() else cells)
        rows = F.when((own > 0) | (rows > 0), F.greatest(own, F.lit(1.0)) * F.greatest(rows, F.lit(1.0))).otherwise(0.0)
    return joined.select(KEY, *[F.col(f"`{n}`") for n in names])


def by_priority(labs: dict[str, DataFrame], target: str) -> Column:
    """First laboratory with a value; laboratories without the column are skipped."""
    return F.coalesce(*[F.col(f"`{n}:{target}`") for n, lab in labs.items() if target in lab.columns])


def coalesced_targets(labs: dict[str, DataFrame], targets: list[str] = LAB_TARGETS,
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every combination of the laboratories' rows with the targets resolved by priority."""
    names = present_targets(list(labs.values()), targets)
    return lab_join(labs, targets, hot_rows).select(KEY, *[by_priority(labs, t).alias(t) for t in names])


def merged_labs(labs: dict[str, DataFrame], targets: list[str] = LAB_TARGETS) -> DataFrame:
    """One row per key: what the full outer joins, the coalesce and the de-duplication leave.

    Joining first multiplies the replicates of a key, to keep one of the combinations in the end.
    Here each laboratory contributes its lowest row per key (values in target order, NULLs last)
    and priority decides between laboratories. That is one aggregation over the union: replicates
    are reduced before the only shuffle, so no key is too hot, and nothing is multiplied.

    Rows without a key never match each other, so their group keeps the lowest single row.
    """
    names = present_targets(list(labs.values()), targets)

    def tagged(name: str, lab: DataFrame) -> DataFrame:
        values = [
            (F.col(f"`{t}`") if t in lab.columns else F.lit(None)).cast("double").alias(f"v{i}")
            for i, t in enumerate(names)
        ]
        return lab.select(KEY, F.lit(name).alias("lab"), *values)

    rows = reduce(DataFrame.unionByName, [tagged(n, lab) for n, lab in labs.items()])
    ordered = []
    for i in range(len(names)):
        ordered += [F.col(f"v{i}").isNull().alias(f"n{i}"), F.col(f"v{i}")]
    lowest = rows.groupBy(KEY).agg(
        *[F.min(F.when(F.col("lab") == n, F.struct(*ordered))).alias(n) for n in labs]
    )
    single = F.least(*[F.col(n) for n in labs]) if len(labs) > 1 else F.col(next(iter(labs)))
    return lowest.select(
        KEY,
        *[
            F.when(F.col(KEY).isNull(), single[f"v{i}"])
            .otherwise(F.coalesce(*[F.col(n)[f"v{i}"] for n in labs]))
            .alias(t)
            for i, t in enumerate(names)
        ],
    )


def with_lab_row(spectra: DataFrame, labs: dict[str, DataFrame], buckets: int = FILTER_BUCKETS) -> DataFrame:
    """``spectra`` without most of those that no laboratory measured, taken out where they lie.

    Keys are hashed to a fixed number of buckets and the buckets that laboratories fill are broadcast, which
    bounds the broadcast whatever the number of keys. A spectrum that shares a bucket by chance stays,
    for the join with the laboratories to drop; with many more keys than buckets all stay.
    """

    def bucket(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(buckets))

    filled = reduce(DataFrame.unionByName, [lab.select(bucket(KEY).alias("_bucket")) for lab in labs.values()]).distinct()
    return spectra.join(F.broadcast(filled), bucket(KEY) == F.col("_bucket"), "left_semi")


def silver_master(spectra: DataFrame, labs: dict[str, DataFrame], targets: list[str] = LAB_TARGETS) -> DataFrame:
    """Targets of every sample with its spectrum, NULL where it was not scanned.

    ``spectra`` has one row per key; both sides are already partitioned by the key, so the join
    adds no shuffle of its own.
    """
    joined = merged_labs(labs, targets).join(spectra, KEY, "left").drop(*LINEAGE_COLUMNS)
    return with_snake_names(joined.withColumn(KEY, blank_to_null(F.col(KEY))))

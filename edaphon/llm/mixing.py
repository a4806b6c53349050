"""Mixing sources to target weights: certain whole copies, then Pareto order sampling.

A document's expected copies are ``min(cap, level * preference)`` with one level per source, chosen
so that the source's expected words meet its target. The whole part is taken for certain; the rest
is the inclusion probability of one more copy. Documents are ranked by their random odds divided by
their inclusion odds; along that order every document is taken whose words fit what the target has
left, and those that do not are stepped over, to the end of the order. One document larger than what is left is
added where that comes nearer, so the words miss the target by at most half the smallest document not taken.

The order is never sorted as a whole: two rounds of 4,096 buckets of the rank find, per source, the
bucket in which the words run out, and only that bucket's rows are put in order. Behind the document that
does not fit the same begins again among the documents no longer than what is left, until no more than
``FILL`` of them remain; those are tried one by one. What is decided is
one row per source (the steps and the fill), so the decision reaches documents by a join on a small
table and texts are not shuffled.

Defined cases: NULL text has no words, target 0 and nothing taken if its source has no words; a
NULL source is a source of its own, ordered last; rows with equal id, source and size are one unit of
the order (taken together); an empty table gives no rows; other columns stay, and clashing names are
replaced by the results. Sources are held as one row each and put in order by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BUCKETS = 4096
ROUNDS = 2
FILL = 64
#: A document's place in the order of its source.
KEY = "struct<rank:double,id:bigint,size:bigint>"
#: A piece of the order that is taken, without its ends.
STEP = f"struct<limit:double,start:{KEY},end:{KEY}>"
#: A place behind every document, whose rank is at most 1.
BEHIND = "named_struct('rank', 2D, 'id', 0L, 'size', 0L)"
#: The level is sought on a grid of powers of two to the half, and interpolated between.
LEVELS = tuple(2 ** (k / 2) for k in range(17))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """One row per source: ``source_size``, ``target``. Sources share all words by weight; one that
    would pass ``cap`` times its size stops there and the excess goes to the others by weight.

    That is ``min(cap * size, share * weight)`` for one ``share``, found along the sources in the
    order in which they stop."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    stop = F.lit(float(cap)) * F.col("source_size")
    everything = W.partitionBy(F.lit(0))
    along = W.partitionBy(F.lit(0)).orderBy("_ratio", F.col("source").asc_nulls_last())
    before = along.rowsBetween(W.unboundedPreceding, -1)
    rest = along.rowsBetween(W.currentRow, W.unboundedFollowing)
    shared = (
        sources.withColumn("_weight", weight)
        .withColumn("_ratio", stop / F.col("_weight"))
        .withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum(stop).over(before), F.lit(0.0)))
        .withColumn("_share", F.col("_left") / F.sum("_weight").over(rest))
        .withColumn("_share", F.max(F.when(F.col("_share") <= F.col("_ratio"), F.col("_share"))).over(everything))
    )
    target = F.least(stop, F.coalesce(F.col("_share") * F.col("_weight"), stop))
    return shared.select("source", "source_size", target.alias("target"))


def with_plan(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """``docs`` joined to the one row of its source; Spark broadcasts the plan if it is small."""
    plan = plan.withColumnRenamed("source", "_plan_source")
    return docs.join(plan, F.col("source").eqNullSafe(F.col("_plan_source")), "left").drop("_plan_source")


def expected_copies(cap: int) -> Column:
    return F.least(F.lit(float(cap)), F.col("level") * F.col("preference"))


def with_rank(rows: DataFrame, cap: int, seed: int) -> DataFrame:
    """Adds ``certain`` copies, ``rank`` in [0, 1] and ``room`` for one more copy."""
    whole = F.floor(F.col("_expected"))
    part = F.col("_expected") - F.col("certain")
    # 53 random bits, in the middle of their step: never 0 or 1
    luck = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("id")), 11) + F.lit(0.5)) / F.lit(2.0**53)
    odds = F.col("_luck") / (1 - F.col("_luck"))
    ratio = odds / (part / (1 - part))
    return (
        rows.withColumn("_expected", F.coalesce(expected_copies(cap), F.lit(0.0)))
        .withColumn("certain", whole.cast("long"))
        .withColumn("_luck", luck)
        .withColumn("rank", F.when(part > 0, ratio / (1 + ratio)).otherwise(F.lit(1.0)))
        .withColumn("room", F.col("certain") < cap)
        .drop("_expected", "_luck")
    )


def levels(sizes: DataFrame, targets: DataFrame, cap: int) -> DataFrame:
    """Adds ``level`` per source: expected words equal the target."""
    rows = with_plan(sizes, targets)
    base = rows.groupBy("source").agg(F.sum(F.col("preference") * F.col("size")).alias("_pull"))
    per = with_plan(targets, base).withColumn("_first", F.when(F.col("_pull") > 0, F.col("target") / F.col("_pull")).otherwise(F.lit(0.0)))
    # a written table of one row per source has a known size, so a hot source need not be dealt out
    per = materialise(per, "mix-first")
    rows = with_plan(sizes, per.select("source", "_first"))
    grid = [F.sum(F.least(F.lit(float(cap)), F.col("_first") * m * F.col("preference")) * F.col("size")) for m in LEVELS]
    sums = rows.groupBy("source").agg(F.array(*grid).alias("_sums"))
    per = with_plan(per, sums)
    # the first grid point that reaches the target, and the line from the one before
    at = F.array_position(F.transform("_sums", lambda x: x >= F.col("target") * (1 - 1e-12)), True).cast("int")
    points = F.array(*[F.lit(m) for m in LEVELS])
    lower, upper = F.get(F.col("_sums"), F.col("_at") - 2), F.get(F.col("_sums"), F.col("_at") - 1)
    low, high = F.get(points, F.col("_at") - 2), F.get(points, F.col("_at") - 1)
    step = F.when(
        F.col("_at") == 1, F.lit(LEVELS[0])
    ).when(F.col("_at") > 1, low + (high - low) * (F.col("target") - lower) / (upper - lower)).otherwise(F.lit(LEVELS[-1]))
    return per.withColumn("_at", at).withColumn("level", F.col("_first") * step).drop("_pull", "_first", "_sums", "_at")


def later(ranked: DataFrame, per: DataFrame) -> DataFrame:
    """The rest of every source's order that still fits: ``source``, the key's columns, ``left`` and ``key``."""
    rows = with_plan(ranked.filter("room").filter("size > 0").select("source", "rank", "id", "size"), per.select("source", "left", "start"))
    rows = rows.withColumn("key", F.struct("rank", "id", "size")).filter("size <= left")
    return rows.filter(F.col("start").isNull() | (F.col("key") > F.col("start"))).drop("start")


def walk(ranked: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per source: the ``steps`` by which the order is taken, the words ``left`` after them, and
    ``start``, the last document stepped over. Steps are made until at most ``FILL`` rows still fit.

    A step takes the documents of up to ``limit`` words from ``start`` to the first that does not fit
    (``end``); the next goes on behind that one, so each is shorter than the one before."""
    certain = ranked.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("_certain"))
    left = F.greatest(F.lit(0.0), F.col("target") - F.coalesce("_certain", F.lit(0)))
    per = with_plan(plan, certain).withColumn("left", left).drop("_certain")
    per = per.withColumn("start", F.lit(None).cast(KEY)).withColumn("steps", F.array().cast(f"array<{STEP}>"))
    per = materialise(per, "mix-left")
    while True:
        count = later(ranked, per).groupBy("source").agg(F.count("*").alias("_n"))
        per = materialise(with_plan(per, count).withColumn("_on", F.coalesce(F.col("_n") > FILL, F.lit(False))).drop("_n"), "mix-rest")
        if per.filter("_on").isEmpty():
            return per.drop("_on")
        per = step(ranked, per)


def step(ranked: DataFrame, per: DataFrame) -> DataFrame:
    """``per`` after one more step of the sources marked ``_on``."""
    rows = later(ranked, per.filter("_on"))
    at = per.filter("_on").select("source", "left", F.lit(0.0).alias("lo"), F.lit(1.0).alias("width"))
    for _ in range(ROUNDS):
        bucket = F.least(F.lit(BUCKETS - 1), F.floor((F.col("rank") - F.col("lo")) / F.col("width") * BUCKETS))
        sums = inside(rows, at).groupBy("source", bucket.alias("_b")).agg(F.sum("size").alias("_s"))
        sums = with_plan(sums, at.select("source", "left"))
        total = F.sum("_s").over(W.partitionBy("source").orderBy("_b"))
        found = sums.withColumn("_total", total).groupBy("source").agg(
            F.min(F.when(F.col("_total") > F.col("left"), F.col("_b"))).alias("_b"),
            F.max(F.when(F.col("_total") <= F.col("left"), F.col("_total"))).alias("_gained"),
        )
        at = (
            with_plan(at, found)
            .withColumn("width", F.col("width") / BUCKETS)
            .withColumn("lo", F.coalesce(F.col("lo") + F.col("_b") * F.col("width"), F.lit(2.0)))
            .withColumn("left", F.col("left") - F.coalesce("_gained", F.lit(0)))
            .drop("_b", "_gained")
        )
        at = materialise(at, "mix-cut")
    units = inside(rows, at).groupBy("source", "key").agg(F.sum("size").alias("words"))
    units = with_plan(units, at.select("source", "left"))
    ends = units.withColumn("_total", F.sum("words").over(W.partitionBy("source").orderBy("key"))).groupBy("source").agg(
        F.min(F.when(F.col("_total") > F.col("left"), F.col("key"))).alias("_end"),
        F.max(F.when(F.col("_total") <= F.col("left"), F.col("_total"))).alias("_gained"),
    )
    after = with_plan(at.select("source", F.col("left").alias("_left")), ends)
    after = after.withColumn("_left", F.col("_left") - F.coalesce("_gained", F.lit(0))).drop("_gained")
    out = with_plan(per, after)
    made = F.array(F.struct(F.col("left").alias("limit"), "start", F.col("_end").alias("end")).cast(STEP))
    out = out.withColumn("steps", F.when(F.col("_on"), F.concat("steps", made)).otherwise(F.col("steps")))
    # with no end all the rest was taken: nothing is left to fit
    start = F.when(F.col("_on"), F.coalesce("_end", F.expr(BEHIND))).otherwise(F.col("start"))
    out = out.withColumn("left", F.coalesce("_left", "left")).withColumn("start", start)
    return materialise(out.drop("_left", "_end", "_on"), "mix-step")


def inside(rows: DataFrame, at: DataFrame) -> DataFrame:
    """``rows`` in the bucket of their source, with its ``lo`` and ``width``."""
    end = F.col("lo") + F.col("width")
    rows = with_plan(rows.drop("left"), at.select("source", "lo", "width"))
    return rows.filter((F.col("rank") >= F.col("lo")) & ((F.col("rank") < end) | ((end >= 1) & (F.col("lo") < 1))))


def in_front(key: Column) -> Column:
    """Whether a ranked document is taken by one of its source's steps."""
    taken = F.exists(
        "steps",
        lambda s: (F.col("size") <= s["limit"]) & (s["start"].isNull() | (key > s["start"])) & (s["end"].isNull() | (key < s["end"])),
    )
    return F.col("room") & F.coalesce(taken, F.lit(False))


def fills(ranked: DataFrame, per: DataFrame) -> DataFrame:
    """Adds ``fill`` per source: of the at most ``FILL`` rows behind the steps those that still fit, in order."""
    units = later(ranked, per).groupBy("source", "left", "key").agg(F.sum("size").alias("words"))
    order = units.groupBy("source", "left").agg(F.sort_array(F.collect_list(F.struct("key", "words"))).alias("_units"))
    chosen = F.aggregate(
        "_units",
        F.struct(F.col("left").alias("left"), F.array().cast(f"array<{KEY}>").alias("keys")),
        lambda a, x: F.when(
            x["words"] <= a["left"],
            F.struct((a["left"] - x["words"]).alias("left"), F.concat(a["keys"], F.array(x["key"])).alias("keys")),
        ).otherwise(a),
    )
    found = with_plan(per.drop("start"), order.select("source", chosen.alias("_chosen")))
    found = found.withColumn("fill", F.coalesce("_chosen.keys", F.array().cast(f"array<{KEY}>")))
    return found.withColumn("left", F.coalesce("_chosen.left", "left")).drop("_chosen")


def overshoot(ranked: DataFrame, per: DataFrame) -> DataFrame:
    """Where one more document, the smallest that is larger than the gap, comes nearer than the gap, adds it to ``fill``."""
    key = F.struct("rank", "id", "size")
    rows = with_plan(ranked.filter("room"), per.select("source", "left", "steps", "fill")).withColumn("key", key)
    rows = rows.filter((F.col("size") > 0) & (F.col("size") < 2 * F.col("left")) & ~in_front(F.col("key")) & ~F.array_contains("fill", F.col("key")))
    units = rows.groupBy("source", "left", "key").agg(F.sum("size").alias("words"))
    units = units.filter((F.col("words") > F.col("left")) & (F.col("words") < 2 * F.col("left")))
    out = with_plan(per, units.groupBy("source").agg(F.min(F.struct("words", "key")).alias("_pick")))
    added = F.concat("fill", F.array(F.col("_pick.key")))
    return out.withColumn("fill", F.when(F.col("_pick").isNotNull(), added).otherwise(F.col("fill"))).drop("left", "_pick")


def sizes_of(docs: DataFrame, id: str, source: str, size: Column, preference: Column | None) -> DataFrame:
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(source).cast("string").alias("source"), size.cast("long").alias("size"))
    return rows.withColumn("preference", F.lit(1.0) if preference is None else preference)


def mixing_plan(
    docs: DataFrame, size: Column, preference: Column | None = None, id: str = "doc_id", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES, seed: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """The plan (one row per source) and the sizes it was made from. ``preference`` is an expression
    on ``size`` by which documents of a source are favoured; all alike without it."""
    sizes = materialise(sizes_of(docs, id, source, size, preference), "mix-sizes")
    targets = materialise(source_targets(sizes, weights, cap), "mix-targets")
    plan = materialise(levels(sizes, targets, cap), "mix-plan")
    ranked = with_rank(with_plan(sizes, plan.select("source", "level")), cap, seed)
    filled = materialise(fills(ranked, walk(ranked, plan)), "mix-fill")
    return materialise(overshoot(ranked, filled), "mix-done"), sizes


def copies(rows: DataFrame, plan: DataFrame, cap: int = MAX_COPIES, seed: int = 1) -> DataFrame:
    """``rows`` (id, source, size, preference and others) with ``copies`` and the plan's figures."""
    key = F.struct("rank", "id", "size")
    extra = in_front(key) | (F.col("room") & F.coalesce(F.array_contains("fill", key), F.lit(False)))
    out = with_rank(with_plan(rows, plan), cap, seed)
    out = out.withColumn("copies", F.col("certain") + F.when(F.col("size") > 0, extra.cast("long")).otherwise(F.lit(0)))
    return out.drop("certain", "rank", "room", "level", "steps", "fill")


def short_first(size: Column) -> Column:
    """A mild preference for shorter documents: the fourth root of the size, inverted."""
    return 1 / F.sqrt(F.sqrt(size + 1))


def mixed_documents(docs: DataFrame, size: Column, preference: Column | None = None, id: str = "doc_id", source: str = "source", **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    plan, _ = mixing_plan(docs, size, preference, id, source, **options)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        F.col(id).cast("long").alias("id"), F.col(source).cast("string").alias("source"), size.cast("long").alias("size"), row.alias("_row")
    ).withColumn("preference", F.lit(1.0) if preference is None else preference)
    taken = copies(rows, plan).filter("copies > 0")
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return taken.select("_row", each.alias("_copy")).select("_row.*")

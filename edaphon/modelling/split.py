"""Seeded train/test split and folds from md5 of the sample key."""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edaphon.functions.hashing import seeded_md5
from edaphon.session import materialise

TEST = -1  # the fold number of held-out test rows
BIN_DIGITS = 3  # leading hex digits that bin the digests: at most 4,096 bins


def _bound(share: float) -> str:
    return format(int(share * 2**32), "08x")


def is_test(key: Column, seed: int = 42, share: float = 0.2) -> Column:
    """Membership from the key alone: no shuffle, and stable when rows are added."""
    return F.substring(seeded_md5(key, seed), 1, 8) < F.lit(_bound(share))


def fold_of(key: Column, seed: int = 42, folds: int = 5) -> Column:
    """Fold number by digest range; a digest other than the split's, so the two are independent."""
    head = F.substring(seeded_md5(key, f"fold{seed}"), 1, 8)
    fold = F.lit(folds - 1)
    for i in reversed(range(folds - 1)):
        fold = F.when(head < F.lit(_bound((i + 1) / folds)), i).otherwise(fold)
    return fold


def with_folds(df: DataFrame, key: str, seed: int = 42, folds: int = 5, share: float = 0.2) -> DataFrame:
    """``fold``: -1 for test rows, else 0 … folds-1."""
    k = F.col(key)
    return df.withColumn("fold", F.when(is_test(k, seed, share), TEST).otherwise(fold_of(k, seed, folds)))


Group = tuple  # the values of the grouping columns
Cuts = dict[Group, list[str]]


def digest_bins(digests: DataFrame, by: list[str]) -> dict[Group, dict[str, int]]:
    """Rows per bin and group. At most ``16 ** BIN_DIGITS`` rows a group reach the driver; groups are targets."""
    counts = digests.groupBy(*by, F.substring("digest", 1, BIN_DIGITS).alias("_bin")).agg(F.count("*").alias("_rows"))
    out: dict[Group, dict[str, int]] = {}
    for row in counts.collect():
        out.setdefault(tuple(row[c] for c in by), {})[row["_bin"]] = row["_rows"]
    return out


def same_group(by: list[str], group: Group) -> Column:
    """Whether a row belongs to a group; a NULL group is a group."""
    match = F.lit(True)
    for column, value in zip(by, group):
        match = match & F.col(column).eqNullSafe(F.lit(value))
    return match


def cut_digests(digests: DataFrame, by: list[str], ranks: dict[Group, list[int]], bins: dict[Group, dict[str, int]]) -> Cuts:
    """Per group the digests of the given ranks (from 1; rank 0 is the empty text, below all digests).

    The bin of a rank follows from the bins' counts, so only the rows of these few bins are put in order."""
    wanted: dict[tuple, list[tuple[int, int]]] = {}  # (group, bin) -> place in the ranks, rank inside the bin
    cuts: Cuts = {g: [""] * len(r) for g, r in ranks.items()}
    for group, own in ranks.items():
        for place, rank in enumerate(own):
            below = 0
            for name, rows in sorted(bins[group].items()) if rank else ():
                if rank <= below + rows:
                    wanted.setdefault((group, name), []).append((place, rank - below))
                    break
                below += rows
    if not wanted:
        return cuts
    chosen = F.lit(False)
    for group, name in wanted:
        chosen = chosen | (same_group(by, group) & F.col("digest").startswith(name))
    inside = Window.partitionBy(*by, F.substring("digest", 1, BIN_DIGITS)).orderBy("digest")
    ranked = digests.filter(chosen).withColumn("_rank", F.row_number().over(inside))
    at = F.lit(False)
    for (group, name), places in wanted.items():
        at = at | (same_group(by, group) & F.col("digest").startswith(name) & F.col("_rank").isin([r for _, r in places]))
    for row in ranked.filter(at).collect():  # a row per cut
        group, name = tuple(row[c] for c in by), row["digest"][:BIN_DIGITS]
        for place, rank in wanted[group, name]:
            if rank == row["_rank"]:
                cuts[group][place] = row["digest"]
    return cuts


def interval(digest: Column, by: list[str], cuts: Cuts) -> Column:
    """How many of its group's cuts a digest lies above. Map only: the cuts are literals."""
    out = F.lit(None).cast("int")
    for group, own in cuts.items():
        above = F.lit(0)
        for cut in own:
            above = above + (digest > F.lit(cut)).cast("int")
        out = F.when(same_group(by, group), above).otherwise(out)
    return out


def split_cuts(digests: DataFrame, by: list[str], share: float) -> Cuts:
    bins = digest_bins(digests, by)
    # the share as a decimal, so that 0.2 · 10 is 2 and not a little above
    sizes = {g: sum(b.values()) for g, b in bins.items()}
    return cut_digests(digests, by, {g: [math.ceil(Decimal(str(share)) * n)] for g, n in sizes.items()}, bins)


def fold_cuts(digests: DataFrame, by: list[str], folds: int) -> Cuts:
    """Folds differ by one row at most, larger ones first."""
    bins = digest_bins(digests, by)
    ranks = {}
    for group, own in bins.items():
        q, r = divmod(sum(own.values()), folds)
        ranks[group] = [f * q + min(f, r) for f in range(1, folds)]
    return cut_digests(digests, by, ranks, bins)


def _distinct(keys: DataFrame, key: str, by: list[str], *seeds: int | str) -> DataFrame:
    """Every key once, as digests: all that is shuffled of a row."""
    named = [seeded_md5(F.col(key), seed).alias(f"digest{i or ''}") for i, seed in enumerate(seeds)]
    distinct = keys.filter(F.col(key).isNotNull()).select(*by, key).distinct()
    return materialise(distinct.select(*by, key, *named), "digests")


def exact_split(keys: DataFrame, key: str, seed: int = 42, share: float = 0.2, by: list[str] = ()) -> DataFrame:
    """``(by…, key, split)`` with exactly ``ceil(share · n)`` test keys per group. NULL keys are left out."""
    by = list(by)
    digests = _distinct(keys, key, by, seed)
    test = interval(F.col("digest"), by, split_cuts(digests, by, share)) == 0
    return digests.select(*by, key, F.when(test, "test").otherwise("train").alias("split"))


def exact_folds(keys: DataFrame, key: str, seed: int = 42, folds: int = 5, by: list[str] = ()) -> DataFrame:
    """``(by…, key, fold)`` with fold sizes that differ by one at most, larger folds first. NULL keys are left out."""
    by = list(by)
    digests = _distinct(keys, key, by, f"fold{seed}")
    return digests.select(*by, key, interval(F.col("digest"), by, fold_cuts(digests, by, folds)).alias("fold"))


def with_exact_folds(df: DataFrame, key: str, by: list[str], seed: int = 42, folds: int = 5,
                     share: float = 0.2) -> DataFrame:
    """As :func:`with_folds`, with exact sizes per group; rows without a key are left out.

    The digests that bound the parts are found when this is called, from the keys alone. The rows themselves are only
    compared with them: no join, and no row is moved."""
    by = list(by)
    digests = _distinct(df, key, by, seed, f"fold{seed}")
    first = split_cuts(digests, by, share)
    train = digests.filter(interval(F.col("digest"), by, first) == 1).select(*by, F.col("digest1").alias("digest"))
    then = fold_cuts(train, by, folds)
    # a group whose rows are all test rows has no folds
    fold = F.coalesce(interval(seeded_md5(F.col(key), f"fold{seed}"), by, then), F.lit(0))
    test = interval(seeded_md5(F.col(key), seed), by, first) == 0
    return df.filter(F.col(key).isNotNull()).withColumn("fold", F.when(test, TEST).otherwise(fold))

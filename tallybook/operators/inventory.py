"""What is there, by class, size, format and name."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe, join_summary
from tallybook.functions.names import free_names
from tallybook.functions.ordering import first_n, running_total
from tallybook.functions.paths import base_name, directory, extension


def class_inventory(df: DataFrame, keys: Sequence[str], size: str = "size") -> DataFrame:
    """Rows and bytes for each combination of ``keys``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("n_bytes"))


def inventory_rollup(df: DataFrame, keys: Sequence[str], size: str = "size") -> DataFrame:
    """Rows and bytes with subtotals from right to left; ``level`` counts rolled-up keys.

    Rows are added up by all keys first: the rollup then copies the few sums
    once for each level, not the rows.
    """
    return (
        class_inventory(df, keys, size)
        .rollup(*keys)
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_bytes").alias("n_bytes"),
            sum((F.grouping(k).cast("int") for k in keys), start=F.lit(0)).alias("level"),
        )
    )


def modality_pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Rows by ``keys`` with one count column per given value of ``column``, and ``other`` for the rest and null."""
    if "other" in values:
        raise ValueError("other counts the values that are not listed")
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    other = F.count_if(~F.coalesce(F.col(column).isin(list(values)), F.lit(False)))
    return df.groupBy(*keys).agg(*counts, other.alias("other"))


def exact_percentiles(
    df: DataFrame, group: Sequence[str], value: str, points: dict[str, float]
) -> DataFrame:
    """n, min, max, mean and exact, linearly interpolated percentiles of ``value`` per group.

    Equal values are counted together, running counts are taken range by range,
    and each percentile needs only the one or two values at its rank. No task
    sees all values of a group. Nulls are left out.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counts, group, [F.col(value)], weight="_n", total="_upto")
    first, last = F.col("_upto") - F.col("_n"), F.col("_upto") - 1

    picked = [
        F.max("group_total").alias("n"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        (F.sum(F.col(value) * F.col("_n")) / F.max("group_total")).alias("mean_value"),
    ]
    for name, point in points.items():
        at = F.lit(point) * (F.col("group_total") - 1)
        for end, rank in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (first <= rank) & (rank <= last)
            picked.append(F.max(F.when(here, F.col(value))).cast("double").alias(f"_{name}_{end}"))
    found = ranked.groupBy(*group).agg(*picked)

    def interpolated(name: str, point: float) -> Column:
        at = F.lit(point) * (F.col("n") - 1)
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (low + (high - low) * (at - F.floor(at))).alias(name)

    return found.select(
        *group,
        "n",
        "min_value",
        "max_value",
        "mean_value",
        *[interpolated(name, point) for name, point in points.items()],
    )


def size_stats(df: DataFrame, group: Sequence[str], size: str = "size", approximate: bool = False) -> DataFrame:
    """I4: n, min, max, mean, p50 and p95 of size per group.

    ``approximate`` trades exact percentiles for a single pass.
    """
    if not approximate:
        return exact_percentiles(df, group, size, {"p50": 0.5, "p95": 0.95}).withColumnsRenamed(
            {"min_value": "min_size", "max_value": "max_size", "mean_value": "avg_size"}
        )
    p50, p95 = (F.percentile_approx(size, p, 10000).cast("double") for p in (0.5, 0.95))
    return (
        df.filter(F.col(size).isNotNull())
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(size).alias("min_size"),
            F.max(size).alias("max_size"),
            F.avg(size).alias("avg_size"),
            p50.alias("p50"),
            p95.alias("p95"),
        )
    )


def size_histogram(df: DataFrame, group: Sequence[str] = (), size: str = "size") -> DataFrame:
    """Rows and bytes by power of two; sizes below 1 fall in a null bin.

    The bin is the number of binary digits less one, which is exact where a
    logarithm in floating point is not.
    """
    power = F.when(F.col(size) > 0, F.length(F.bin(size)) - 1).alias("power")
    return df.groupBy(*group, power).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(size).alias("n_bytes"))


def size_outliers(df: DataFrame, group: Sequence[str], size: str = "size", reach: float = 1.5) -> DataFrame:
    """Rows beyond ``reach`` times the interquartile range, with ``low_fence`` and ``high_fence`` (a name the table has gets an underscore).

    The fences are one row per group, so the rows themselves are not shuffled.
    """
    low, high = free_names(df.columns, "low_fence", "high_fence")
    quartiles = exact_percentiles(df, group, size, {"q1": 0.25, "q3": 0.75})
    span = F.col("q3") - F.col("q1")
    fences = quartiles.select(
        *group, (F.col("q1") - reach * span).alias(low), (F.col("q3") + reach * span).alias(high)
    )
    return join_summary(df, fences, group).filter((F.col(size) < F.col(low)) | (F.col(size) > F.col(high)))


def largest_k(df: DataFrame, group: Sequence[str], k: int, size: str = "size", path: str = "path") -> DataFrame:
    """The ``k`` largest rows of each group, ties by path, with their rank."""
    return first_n(df, group, [F.col(size).desc(), F.col(path)], k)


def class_weights(df: DataFrame, label: str, within: Sequence[str] = ()) -> DataFrame:
    """I8: n and weight = total / (classes * n) per class; rows without a class are left out."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(*within, label).agg(F.count(F.lit(1)).alias("n"))
    sums = [F.sum("n").alias("_total"), F.count(F.lit(1)).alias("_classes")]
    weight = (F.col("_total") / (F.col("_classes") * F.col("n"))).alias("weight")
    if within:
        joined = join_null_safe(counts, counts.groupBy(*within).agg(*sums), within)
    else:
        total, classes = (counts.select(s).scalar() for s in sums)
        joined = counts.withColumns({"_total": total, "_classes": classes})
    return joined.select(*within, label, "n", weight)


def format_audit(
    df: DataFrame, group: str, path: str = "path", kind: Column | None = None, minority_below: float = 0.5
) -> DataFrame:
    """Kind of file (extension by default) per group: n, share, and whether it is the minority.

    ``kind`` comes from few values; shares are taken over the counted result.
    """
    kind = extension(path) if kind is None else kind
    counts = df.groupBy(group, kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(group).agg(F.sum("n").alias("_total"))
    share = F.col("n") / F.col("_total")
    return join_null_safe(counts, totals, [group]).select(
        group, "kind", "n", share.alias("share"), (share < minority_below).alias("is_minority")
    )


def name_collisions(
    df: DataFrame, name: Column | None = None, place: Column | None = None
) -> DataFrame:
    """Name, n_places, n_rows for names (base names by default) found in several places."""
    name = base_name("path") if name is None else name
    place = directory("path") if place is None else place
    per_place = (
        df.select(name.alias("name"), place.alias("_place"))
        .filter(F.col("name").isNotNull() & F.col("_place").isNotNull())
        .groupBy("name", "_place")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        per_place.groupBy("name")
        .agg(F.count(F.lit(1)).alias("n_places"), F.sum("_n").alias("n_rows"))
        .filter(F.col("n_places") > 1)
    )


def distinct_estimate(df: DataFrame, group: Sequence[str] = (), oid: str = "oid", rsd: float = 0.05) -> DataFrame:
    """Estimated number of oids from one pass and a sketch of fixed size."""
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.approx_count_distinct(oid, rsd).alias("n_oids_estimate")
    )


def label_coverage(df: DataFrame, group: Sequence[str], label: str = "label") -> DataFrame:
    """Rows, labelled rows and their share per group."""
    labelled = F.count_if(F.col(label).isNotNull())
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        labelled.alias("n_labelled"),
        (labelled / F.count(F.lit(1))).alias("share"),
    )

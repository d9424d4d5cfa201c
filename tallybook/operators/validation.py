"""M3 and M5: records and payloads that are not what they should be."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.sources.pointers import POINTER_VERSION


def validate(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Adds ``reason``: the name of the first check that finds a fault, else null.

    A check that comes out null counts as a fault.
    """
    reason = None
    for name, fault in checks:
        found = F.coalesce(fault, F.lit(True))
        reason = F.when(found, name) if reason is None else reason.when(found, name)
    return df.withColumn("reason", reason)


def validate_manifest(parsed: DataFrame) -> DataFrame:
    """M3 for scanned and path-parsed pointers; needs version, oid, size, well_formed, path_problem."""
    problem = F.col("path_problem")
    return validate(
        parsed,
        [
            ("bad version", F.col("version") != POINTER_VERSION),
            ("bad oid", ~F.col("oid").rlike(r"\A[0-9a-f]{64}\z")),
            ("bad size", F.col("size").isNull()),
            ("size not positive", F.col("size") <= 0),
            ("bad layout", ~F.col("well_formed")),
            ("no rule for path", F.coalesce(problem == "no rule", F.lit(False))),
            ("name disagrees", F.coalesce(problem == "name disagrees", F.lit(False))),
        ],
    )


def quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows (without ``reason``) and faulty rows (with it)."""
    return checked.filter(F.col("reason").isNull()).drop("reason"), checked.filter(F.col("reason").isNotNull())


def verify_payloads(
    manifest: DataFrame, payloads: DataFrame, key: str = "path", oid: str = "oid", size: str = "size"
) -> DataFrame:
    """M5: key and status (ok, missing, no declaration, wrong size, wrong hash) of each manifest row.

    ``payloads`` has the key, actual_oid and actual_size; the content itself was
    hashed where it was read and takes no part in the join. Only a proven match is
    ``ok``: a row that declares no hash or no size is ``no declaration``.
    """
    actual = payloads.select(key, "actual_oid", "actual_size", F.lit(True).alias("_there"))
    status = (
        F.when(F.col("_there").isNull(), "missing")
        .when(F.col(oid).isNull() | F.col(size).isNull(), "no declaration")
        .when(~F.col("actual_size").eqNullSafe(F.col(size)), "wrong size")
        .when(~F.col("actual_oid").eqNullSafe(F.col(oid)), "wrong hash")
        .otherwise("ok")
    )
    return manifest.select(key, oid, size).join(actual, key, "left").select(key, status.alias("status"))

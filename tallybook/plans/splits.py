"""Splits in which linked entities stay together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_summary
from tallybook.operators.groups import SPLIT_NAMES, SPLIT_SHARES, group_split, linked_groups


def leak_free_split(
    df: DataFrame,
    member: str,
    via: str,
    names: Sequence[str] = SPLIT_NAMES,
    shares: Sequence[int] = SPLIT_SHARES,
) -> DataFrame:
    """G3 then G4: adds component, bucket and split, so that no ``via`` value crosses splits.

    Rows without a member are left out, as they belong to no entity.
    """
    components = linked_groups(df, member, via)
    placed = join_summary(df.dropna(subset=[member]), components, [member])
    return group_split(placed, F.col("component").cast("string"), names, shares)

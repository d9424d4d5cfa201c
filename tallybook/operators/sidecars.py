"""Attributes that rows carry as JSON text, read by type."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.names import free_name


def read_attributes(df: DataFrame, text: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``fields`` (name: path, type) and ``attribute_problem``, null when all is well.

    The text is parsed once, to a variant, and fields are taken from that. ``not json`` marks text that cannot be parsed, ``wrong type:
    <name>`` the first field that is there and does not fit its type. A null text, a null value and a missing field are
    null and no problem. Faulty rows stay, so that they can be put in quarantine.
    """
    parsed = free_name([*df.columns, *fields], "variant")
    rows = df.withColumn(parsed, F.try_parse_json(text))
    problem = F.when(F.col(text).isNotNull() & F.col(parsed).isNull(), "not json")
    values = {}
    for name, (path, kind) in fields.items():
        values[name] = F.try_variant_get(parsed, path, kind)
        there = F.try_variant_get(parsed, path, "string").isNotNull() | F.try_variant_get(parsed, path, "variant").isNotNull()
        null = F.coalesce(F.is_variant_null(F.try_variant_get(parsed, path, "variant")), F.lit(False))
        problem = problem.when(there & ~null & values[name].isNull(), f"wrong type: {name}")
    return rows.withColumns({**values, "attribute_problem": problem}).drop(parsed)

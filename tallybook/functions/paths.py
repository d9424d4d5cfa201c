"""M2: attributes that paths carry, read with anchored patterns and no UDF."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PathRule:
    """Paths of one origin: an anchored pattern and the column each group fills."""

    origin: str
    pattern: str
    columns: tuple[str, ...]


# Origin folders and path layouts of the pointer tree.
PATH_RULES = (
    PathRule(
        "fluo_sc",
        r"^fluo_sc/(CLI|FLUO)/(ACK|BCC|MEL|NEV|SEK)/(CLI|FLUO)_(ACK|BCC|MEL|NEV|SEK)_(\d+)\.(jpg)$",
        ("modality", "label", "name_modality", "name_label", "ordinal", "ext"),
    ),
    PathRule(
        "oral_images",
        r"^oral_images/(benign|malignant)_lesions/(\d+)\.(jpg|jpeg)$",
        ("label", "ordinal", "ext"),
    ),
    PathRule(
        "pad_ufes_20",
        r"^pad_ufes_20/images/PAT_(\d+)_(\d+)_(\d+)\.(png)$",
        ("patient", "lesion", "image_no", "ext"),
    ),
    PathRule(
        "pmc_vqa",
        r"^pmc_vqa/train-(\d{5})-of-(\d{5})/pmc_train_(\d+)\.(jpg)$",
        ("shard", "shard_total", "ordinal", "ext"),
    ),
    PathRule(
        "scin",
        r"^scin/(-?\d+)/image_(\d+)\.(png)$",
        ("case_id", "image_no", "ext"),
    ),
)

# Attribute columns of a manifest, in order.
ATTRIBUTES = {
    "modality": T.StringType(),
    "label": T.StringType(),
    "shard": T.IntegerType(),
    "shard_total": T.IntegerType(),
    "ordinal": T.IntegerType(),
    "patient": T.IntegerType(),
    "lesion": T.IntegerType(),
    "image_no": T.IntegerType(),
    "case_id": T.StringType(),
    "ext": T.StringType(),
}


def directory(path: str | Column = "path") -> Column:
    """Everything before the last slash."""
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def base_name(path: str | Column = "path") -> Column:
    """Everything after the last slash."""
    return F.substring_index(path, "/", -1)


def extension(path: str | Column = "path") -> Column:
    """Lower-case letters after the last dot of the base name, or null."""
    found = F.regexp_extract(path, r"\.([^./]+)$", 1)
    return F.nullif(F.lower(found), F.lit(""))


# What a path may say twice; the second saying must agree with the first.
REPEATED = {"name_modality": "modality", "name_label": "label"}

_MATCHED = "matched"


def _layout(rule: PathRule, fields: Sequence[str]) -> str:
    """Replacement that puts the groups of a rule in the order of ``fields``, slash-separated."""
    return "/".join([_MATCHED, *[f"${rule.columns.index(f) + 1}" if f in rule.columns else "" for f in fields]])


def parse_path(df: DataFrame, rules: Sequence[PathRule] = PATH_RULES, path: str = "path") -> DataFrame:
    """Adds origin, the ATTRIBUTES columns and ``path_problem`` (null when all is well).

    ``path_problem`` is ``no rule`` for a path that fits no pattern and ``name
    disagrees`` where folder and file name give different modality or label. The
    origin is the first folder and picks the one pattern a path is tried against,
    once: the match is rewritten as all fields in one order and split at slashes.
    """
    fields = [*ATTRIBUTES, *REPEATED]
    rewritten = None
    for rule in rules:
        here, text = F.col("origin") == rule.origin, F.regexp_replace(path, rule.pattern, _layout(rule, fields))
        rewritten = F.when(here, text) if rewritten is None else rewritten.when(here, text)

    def field(name: str) -> Column:
        return F.when(F.col("_fits"), F.nullif(F.get("_fields", F.lit(fields.index(name) + 1)), F.lit("")))

    disagrees = F.lit(False)
    for second, first in REPEATED.items():
        disagrees = disagrees | (field(second) != field(first))
    attributes = {
        name: field(name) if isinstance(kind, T.StringType) else field(name).try_cast(kind)
        for name, kind in ATTRIBUTES.items()
    }
    return (
        df.withColumn("origin", F.substring_index(path, "/", 1))
        .withColumn("_fields", F.split(rewritten, "/"))
        .withColumn("_fits", F.coalesce(F.get("_fields", F.lit(0)) == _MATCHED, F.lit(False)))
        .withColumns({**attributes, "path_problem": F.when(~F.col("_fits"), "no rule").when(disagrees, "name disagrees")})
        .drop("_fields", "_fits")
    )

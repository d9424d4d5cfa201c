"""Jobs on manifests, by family; each is a function from DataFrame to DataFrame."""

from tallybook.operators.completeness import (
    missing_ordinals,
    missing_ranges,
    missing_shard_ranges,
    missing_shards,
    misrouted,
    ordinal_islands,
    routing_check,
    shard_fill,
    size_cap_audit,
)
from tallybook.operators.duplicates import (
    cross_partition_duplicates,
    dedup_savings,
    duplicate_groups,
    duplicate_runs,
    exact_dedup,
    identity_conflicts,
    origin_overlap,
)
from tallybook.operators.groups import (
    capped_sample,
    entity_hierarchy,
    group_split,
    linked_groups,
    shared_children,
    split_leakage,
    stratified_split,
)
from tallybook.operators.inventory import (
    class_inventory,
    class_weights,
    distinct_estimate,
    exact_percentiles,
    format_audit,
    inventory_rollup,
    label_coverage,
    largest_k,
    modality_pivot,
    name_collisions,
    size_histogram,
    size_outliers,
    size_stats,
)
from tallybook.operators.pairing import matched_pairs, pair_coverage, pair_size_ratio, repeated_partners, unpaired
from tallybook.operators.snapshots import diff_rows, manifest_diff, write_snapshot
from tallybook.operators.temporal import asof_join, interval_join
from tallybook.operators.validation import quarantine, validate, validate_manifest, verify_payloads

__all__ = [
    "asof_join",
    "capped_sample",
    "class_inventory",
    "class_weights",
    "cross_partition_duplicates",
    "dedup_savings",
    "diff_rows",
    "distinct_estimate",
    "duplicate_groups",
    "duplicate_runs",
    "entity_hierarchy",
    "exact_dedup",
    "exact_percentiles",
    "format_audit",
    "group_split",
    "identity_conflicts",
    "interval_join",
    "inventory_rollup",
    "label_coverage",
    "largest_k",
    "linked_groups",
    "manifest_diff",
    "matched_pairs",
    "missing_ordinals",
    "missing_ranges",
    "missing_shard_ranges",
    "missing_shards",
    "misrouted",
    "modality_pivot",
    "name_collisions",
    "ordinal_islands",
    "origin_overlap",
    "pair_coverage",
    "pair_size_ratio",
    "quarantine",
    "repeated_partners",
    "routing_check",
    "shard_fill",
    "shared_children",
    "size_cap_audit",
    "size_histogram",
    "size_outliers",
    "size_stats",
    "split_leakage",
    "stratified_split",
    "unpaired",
    "validate",
    "validate_manifest",
    "verify_payloads",
    "write_snapshot",
]

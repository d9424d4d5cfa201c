from tallybook.functions.hashing import as_key, hash_bucket, split_by_bucket, uniform_key
from tallybook.functions.joins import join_null_safe, join_summary
from tallybook.functions.ordering import first_n, running_total, with_runs
from tallybook.functions.names import free_name, free_names
from tallybook.functions.paths import PATH_RULES, PathRule, base_name, directory, extension, parse_path
from tallybook.functions.storage import clear_scratch, scratch_path, shared_dir, store

__all__ = [
    "PATH_RULES",
    "PathRule",
    "as_key",
    "base_name",
    "clear_scratch",
    "directory",
    "extension",
    "first_n",
    "free_name",
    "free_names",
    "hash_bucket",
    "join_null_safe",
    "join_summary",
    "parse_path",
    "running_total",
    "scratch_path",
    "shared_dir",
    "split_by_bucket",
    "store",
    "uniform_key",
    "with_runs",
]

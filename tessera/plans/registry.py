"""Registry of query plans (name -> callable(spark, sf_dir))."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import model_queries as M
from tessera.plans import queries as Q

_TABLE_QUERIES = [
    "clean_join", "row_mean_rank", "ratio_argmax", "nth_label", "lookup_cell", "corr_pair", "group_stats",
    "describe", "profile", "group_median_fill", "median_fill", "mode_fill", "impute_rules", "class_counts",
    "distinct_values", "pop_mean_std", "extremes", "ambiguous_keys", "unique_keys", "groups_all",
    "eliminate_by_groups", "range_pairs", "theta_sums", "range_matches", "least_tier",
    "metric_row", "user_function", "group_members", "array_load", "feature_vector", "deepest_basin", "running_bank", "first_reaching",
    "capacity_lookup", "top_abs", "sorted_nulls_last", "random_rows", "array_scale", "dot", "text_clean",
    "dummies", "label_codes", "one_hot", "standardize", "hash_split", "stratified_split", "folds",
    "metrics", "auc", "r2", "half_mse", "threshold_sweep", "confusion", "scores_by_split", "metrics_table",
]


def _wrap(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from tessera.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _wrap(getattr(Q, name)) for name in _TABLE_QUERIES}
    out.update({name: _wrap(fn) for name, fn in M.QUERIES.items()})
    return out

"""Data-quality operators: repair of readings, outlier tests, and reports."""

from sensorlake.operators.quality.cleaning import (
    clean,
    dedup_latest,
    drop_helpers,
    impute_mean,
    repair,
    replace_outliers,
    with_group_stats,
    with_sigma_band,
    with_z_score,
)
from sensorlake.operators.quality.direction import angular_distance, circular_stats, direction_outliers, repair_direction
from sensorlake.operators.quality.gaps import missing_days, outages
from sensorlake.operators.quality.outliers import (
    box_stats,
    iqr_outliers,
    iqr_summary,
    sigma_outliers,
    with_test_points,
    z_outliers,
)
from sensorlake.operators.quality.quantiles import quantiles, quartiles
from sensorlake.operators.quality.reports import (
    completeness,
    daily_counts,
    last_seen,
    null_counts,
    overall_mean,
    profile,
    series,
    series_extremes,
)

__all__ = [
    "angular_distance",
    "box_stats",
    "circular_stats",
    "clean",
    "completeness",
    "daily_counts",
    "dedup_latest",
    "direction_outliers",
    "drop_helpers",
    "impute_mean",
    "iqr_outliers",
    "iqr_summary",
    "last_seen",
    "missing_days",
    "null_counts",
    "outages",
    "overall_mean",
    "profile",
    "quantiles",
    "quartiles",
    "repair",
    "repair_direction",
    "replace_outliers",
    "series",
    "series_extremes",
    "sigma_outliers",
    "with_group_stats",
    "with_sigma_band",
    "with_test_points",
    "with_z_score",
    "z_outliers",
]

from tidelane.operators.asof import (
    Feed,
    align_series,
    asof_join,
    fill_from_secondary,
    latest_within,
    regularize,
    regularize_filled,
)
from tidelane.operators.audit import audit_series, collect_audit
from tidelane.operators.buckets import (
    bucket_by_type,
    bucket_first,
    bucket_mean,
    bucket_mean_first,
    resample_mean_join,
)
from tidelane.operators.columns import (
    cast_columns,
    coalesce_columns,
    drop_all_null_rows,
    drop_any_null_rows,
    ensure_columns,
    filter_value,
    first_per_time,
    first_rows,
    last_rows,
    select_as,
    slice_time,
    sort_by_time,
)
from tidelane.operators.flags import (
    default_flag,
    drop_flagged,
    flag_tsg,
    null_flag_where_missing,
    null_flag_where_nan,
    threshold_flag,
)
from tidelane.operators.grid import join_on_grid, time_bounds, time_grid
from tidelane.operators.intervals import flag_intervals, period_extracts
from tidelane.operators.lag import (
    find_gaps,
    gap_context,
    instants,
    irregular_intervals,
    lag_diff,
    non_monotonic,
    position_jumps,
    regularity_report,
    sampling_interval,
    series_completeness,
    with_previous,
)
from tidelane.operators.reports import (
    correlation,
    describe_series,
    duplicate_times,
    flag_counts,
    missing_report,
    null_count,
    quality_scores,
    row_range,
)
from tidelane.operators.rolling import rolling_deviation, rolling_outlier_rows, rolling_outliers
from tidelane.operators.validate import (
    check_feed,
    range_report,
    table_overlap,
    validate_feed,
    validate_feeds,
    validate_gps,
    validate_oxygen,
    validate_ph,
    validate_rho,
    validate_tsg,
)

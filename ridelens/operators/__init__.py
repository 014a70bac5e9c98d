"""DataFrame operators of the trip model."""

from ridelens.operators.clean import (  # noqa: F401
    clean_predicate,
    clean_predicates,
    clean_trips,
    cleaning_ledger,
    drop_all_duplicates,
    duplicate_keys,
    keep_in,
    null_audit,
)
from ridelens.operators.conform import (  # noqa: F401
    arg_max,
    arg_min,
    canonical_id,
    canonical_name,
    conflict_audit,
    conform_station,
    conform_stations,
    distinct_count,
    pair_counts,
    unique_stations,
)
from ridelens.operators.derive import (  # noqa: F401
    checked_cast,
    derive_rides,
    derive_rides_legacy,
    narrow,
    type_timestamps,
    type_trips,
)
from ridelens.operators.distribution import (  # noqa: F401
    boxplot_outliers,
    boxplot_stats,
    bucketed_quantiles,
    histogram,
    value_counts,
)
from ridelens.operators.geo import (  # noqa: F401
    area_totals,
    left_merge,
    polygon_edges,
    quadtree_cover,
    within_join,
)
from ridelens.operators.identity import connected_components, station_identity, station_pairs, unify_stations  # noqa: F401
from ridelens.operators.monthly import (  # noqa: F401
    merged_sketches,
    merged_stats,
    merged_time_rollup,
    month_sketches,
    replace_months,
    time_state,
)
from ridelens.operators.ordered import ordered, write_ordered  # noqa: F401
from ridelens.operators.outliers import drop_zscore, zscore, zscore_stats  # noqa: F401
from ridelens.operators.predicates import (  # noqa: F401
    delete_where,
    drop_both_blank,
    drop_longer_than,
    drop_missing,
    drop_non_positive_span,
    drop_shorter_than,
    duration_between,
    exclude_like,
    min_trips,
)
from ridelens.operators.rollup import (  # noqa: F401
    avg_duration,
    frequency,
    od_rollup,
    station_trips,
    time_rollup,
    time_rollup_legacy,
    top_stations,
    usage_by,
    usage_frames,
)
from ridelens.operators.share import cumulative, share_of_total, share_segments, share_within  # noqa: F401

from segrec.functions.expressions import (  # noqa: F401
    activity_label,
    argmin,
    describe,
    epoch_seconds_ntz,
    rating_label,
    recommendation_score,
    shorten,
    split_bucket,
    squared_distance,
    threshold_bucket,
)

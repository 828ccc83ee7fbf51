"""Column expressions (labels, scores, date arithmetic) built from Spark built-ins only."""

from laminar.functions.dates import days_since, month_key, months_since
from laminar.functions.labels import (
    churn_risk,
    lifetime_value,
    performance_category,
    rfm_segment,
    spend_tier,
    threshold_label,
    transaction_frequency,
)
from laminar.functions.scoring import (
    growth_pct,
    higher_is_better_score,
    recency_score,
    retention_rate,
    rfm_code,
    safe_mean,
)

__all__ = [
    "churn_risk",
    "days_since",
    "growth_pct",
    "higher_is_better_score",
    "lifetime_value",
    "month_key",
    "months_since",
    "performance_category",
    "recency_score",
    "retention_rate",
    "rfm_code",
    "rfm_segment",
    "safe_mean",
    "spend_tier",
    "threshold_label",
    "transaction_frequency",
]

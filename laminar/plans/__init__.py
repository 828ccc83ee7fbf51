"""Gold datasets (G1-G7) and the end-to-end layer run."""

from laminar.plans.cohort import cohort_analysis, cohort_cells, cohort_sizes, first_purchase
from laminar.plans.customer import customer_analytics, customer_segments, customer_summary
from laminar.plans.product import product_analytics, product_summary, rank_products
from laminar.plans.rfm import rfm_base, rfm_cut_table, rfm_segments
from laminar.plans.timeseries import daily_metrics, monthly_metrics

__all__ = [
    "cohort_analysis",
    "cohort_cells",
    "cohort_sizes",
    "customer_analytics",
    "customer_segments",
    "customer_summary",
    "daily_metrics",
    "first_purchase",
    "monthly_metrics",
    "product_analytics",
    "product_summary",
    "rank_products",
    "rfm_base",
    "rfm_cut_table",
    "rfm_segments",
]

"""Constants that are part of the results, gathered as keyword defaults."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    # Results depend on them, so they are the documented defaults.
    snapshot: dt.date = dt.date(2024, 3, 31)
    churn_days: int = 90
    purchase_status: str = "Completed"
    iqr_factor: float = 3.0
    min_lifetime_days: int = 1
    period_days: int = 30
    clv_periods: int = 12
    kmeans_k: int = 5
    kmeans_restarts: int = 10
    test_share: float = 0.20
    trees: int = 200
    tree_depth: int = 8
    min_split: int = 10
    max_bins: int = 256
    seed: int = 42
    alpha: float = 0.05


DEFAULT = Config()

TABLES = ("customers", "orders", "products", "payments", "reviews")

# Model columns.
NUMERIC_FEATURES = (
    "age", "recency_days", "frequency", "monetary", "avg_order_value", "purchase_frequency",
    "customer_lifetime", "clv", "loyalty_points", "avg_review_rating", "total_reviews",
)
CATEGORICAL_FEATURES = ("gender", "customer_segment", "favourite_category", "preferred_channel")
TARGET = "churned"

# Columns of the correlation heat map.
HEATMAP_COLUMNS = (
    "age", "recency_days", "frequency", "monetary", "avg_order_value",
    "customer_lifetime", "clv", "loyalty_points", "avg_review_rating", "churned",
)

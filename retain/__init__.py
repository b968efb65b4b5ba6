"""Customer-retention analytics on Spark DataFrames."""

from retain.config import DEFAULT, Config
from retain.operators.churn import feature_importance, prepare_features, train_churn_model
from retain.operators.cleaning import clean_all, cleaning_summary
from retain.operators.evaluation import evaluate_model
from retain.operators.features import build_customer_features, feature_summary
from retain.operators.kpis import insights
from retain.operators.profiling import data_quality_report, quality_warnings, table_summary
from retain.operators.statistics import correlation_analysis, hypothesis_test
from retain.plans.marts import chart_tables, dashboard_tables, run_analysis, segment_customers
from retain.sources.bundle import Bundle, load_all, write_table

__all__ = [
    "DEFAULT", "Bundle", "Config", "build_customer_features", "chart_tables", "clean_all",
    "cleaning_summary", "correlation_analysis", "dashboard_tables", "data_quality_report",
    "evaluate_model", "feature_importance", "feature_summary", "hypothesis_test", "insights",
    "load_all", "prepare_features", "quality_warnings", "run_analysis", "segment_customers",
    "table_summary", "train_churn_model", "write_table",
]

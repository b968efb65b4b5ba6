"""The whole analysis: raw tables in, every result table out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame

from retain.config import DEFAULT, Config
from retain.operators import churn, evaluation, kmeans, kpis, migration, profiling
from retain.operators import retention, revenue, segmentation, star, statistics
from retain.operators.cleaning import clean_all, cleaning_summary
from retain.operators.features import build_customer_features, feature_summary
from retain.session import materialize
from retain.sources.bundle import Bundle, write_table


def segment_customers(
    feat: DataFrame, config: Config = DEFAULT
) -> tuple[DataFrame, KMeansModel, DataFrame]:
    """Both segmentations: the enriched table, the k-means model and its scaling row."""
    return kmeans.kmeans_segmentation(segmentation.rfm_segmentation(feat), config)


def stage(bundle: Bundle, label: str) -> Bundle:
    """Write the tables once, so that every later result reads columns instead of recomputing."""
    return Bundle(
        **{name: materialize(df, f"{label}-{name}") for name, df in bundle.items()},
        order_lines=None
        if bundle.order_lines is None
        else materialize(bundle.order_lines, f"{label}-order_lines"),
    )


def chart_tables(
    clean: Bundle, segmented: DataFrame, importance: DataFrame | None = None, config: Config = DEFAULT
) -> dict[str, DataFrame]:
    """The table behind each chart."""
    buyers = segmented.filter("clv > 0")
    charts = {
        "revenue_trend": revenue.monthly_revenue(clean.orders, config),
        "customer_segments": segmentation.value_counts(segmented, "rfm_segment"),
        "churn_distribution": segmentation.value_counts(segmented, "churned"),
        "clv_by_churn": statistics.box_plot(buyers, "churned", "clv"),
        "retention_curve": retention.monthly_retention(clean.orders, config),
        "cohort_heatmap": retention.cohort_matrix(clean.orders, clean.customers, config=config),
        "clv_distribution": statistics.histogram(buyers, "clv", 40, cap_at=0.95),
        "clv_by_segment": segmentation.clv_by_segment(segmented, active_only=True),
        "rfm_scatter": segmentation.rfm_scatter(segmented, seed=config.seed),
        "top_products": revenue.top_products(clean.lines, clean.products, config=config),
        "correlation_heatmap": statistics.correlation_matrix(segmented),
    }
    if importance is not None:
        charts["feature_importance"] = importance.limit(12)
    return charts


def dashboard_tables(clean: Bundle, segmented: DataFrame, config: Config = DEFAULT) -> dict[str, DataFrame]:
    """KPI cards, dashboard pages and the star schema."""
    states = materialize(migration.customer_states(clean.orders, config=config), "states")
    return {
        "kpis": kpis.kpis(segmented, clean.orders, clean.reviews, config),
        "kpi_targets": kpis.kpi_targets(segmented, clean.orders, clean.reviews, config),
        "mom_growth": revenue.mom_growth(clean.orders, config),
        "mtd_revenue": revenue.mtd_revenue(clean.orders, config),
        "customer_funnel": kpis.customer_funnel(segmented),
        "revenue_by_channel": revenue.revenue_by_channel(clean.orders, config),
        "segment_migration": migration.segment_migration(states),
        "churn_by_segment": segmentation.churn_by_segment(segmented),
        "revenue_by_category": revenue.revenue_by_category(clean.lines, clean.products, config),
        "rating_by_category": revenue.rating_by_category(clean.reviews, clean.products),
        "revenue_discount_corr": revenue.revenue_discount_corr(clean.lines, config),
        "stock_vs_demand": revenue.stock_vs_demand(clean.lines, clean.products, config),
        "clv_vs_frequency": kpis.clv_vs_frequency(segmented),
        "clv_projection": kpis.clv_projection(segmented),
        "top_customers_clv": kpis.top_customers_clv(segmented),
        "dim_date": star.dim_date(clean.orders),
        "star_fact": star.star_fact(clean.lines, clean.customers, clean.products, clean.payments),
    }


@dataclass(frozen=True)
class Analysis:
    clean: Bundle
    features: DataFrame
    churn_model: churn.ChurnModel
    kmeans_model: KMeansModel
    tables: dict[str, DataFrame]
    welch: dict[str, object]

    def write(self, folder: str, fmt: str = "parquet", mode: str = "errorifexists") -> list[str]:
        """Write every result table, and the feature table for BI tools."""
        tables = {**self.tables, "customer_features": self.features}
        return [
            write_table(df, f"{folder.rstrip('/')}/{name}", fmt, mode) for name, df in tables.items()
        ]


def run_analysis(raw: Bundle, config: Config = DEFAULT) -> Analysis:
    """Clean, derive features, segment, model, and build every result table.

    The cleaned tables and the feature table are written once to the shared folder; results
    are lazy frames over them.
    """
    clean = stage(clean_all(raw, staged=True), "clean")
    features = materialize(
        build_customer_features(
            clean.customers, clean.orders, clean.products, clean.reviews, clean.order_lines, config
        ),
        "features",
    )
    segmented, kmeans_model, _ = segment_customers(features, config)
    segmented = materialize(segmented, "segmented")
    fitted = churn.train_churn_model(segmented, config)
    importance = churn.feature_importance(fitted)
    metrics, confusion = evaluation.evaluate_model(fitted.predictions)
    quality = metrics.first().asDict()
    findings = kpis.insights(segmented, clean.orders, clean.products, clean.order_lines, config)
    tables = {
        "data_quality_report": profiling.data_quality_report(raw),
        "cleaning_summary": cleaning_summary(raw, clean),
        "feature_summary": feature_summary(segmented),
        "segment_summary": segmentation.segment_summary(segmented),
        "kmeans_counts": segmentation.value_counts(segmented, "kmeans_segment"),
        "clv_by_rfm_segment": segmentation.clv_by_segment(segmented),
        "churn_metrics": metrics,
        "confusion_matrix": confusion,
        "feature_importances": importance,
        "corr_with_churn": statistics.correlation_analysis(segmented),
        "insights": findings,
        "insight_sentences": kpis.insight_sentences(findings, quality),
        **chart_tables(clean, segmented, importance, config),
        **dashboard_tables(clean, segmented, config),
    }
    return Analysis(clean, segmented, fitted, kmeans_model, tables, statistics.hypothesis_test(segmented, config))

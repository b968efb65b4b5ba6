"""The whole analysis over a small copy of the star."""

from retain import Config, run_analysis
from retain.plans.marts import Analysis
from retain.sources import retail_star

SF_DIR = "/root/testdata/sf0.001"


def test_run_analysis(spark, tmp_path):
    raw = retail_star.bundle_with_duplicates(spark, SF_DIR)
    analysis = run_analysis(raw, Config(snapshot=retail_star.SNAPSHOT, trees=10, kmeans_restarts=1))
    customers = analysis.features.count()
    assert customers == analysis.clean.customers.count() > 0
    tables = analysis.tables
    assert sum(r.customers for r in tables["customer_segments"].collect()) == customers
    assert sum(r.customers for r in tables["kmeans_counts"].collect()) == customers
    assert tables["churn_metrics"].first().roc_auc > 0.9
    summary = {r.table_name: r for r in tables["cleaning_summary"].collect()}
    assert summary["Customers"].rows_removed > 0
    assert tables["customer_funnel"].filter("stage = 'New'").first().customers == customers
    assert len(tables) == 41
    assert analysis.welch["significant"] in (True, False) and tables["insight_sentences"].count() == 6
    for mode in ("errorifexists", "overwrite"):
        small = Analysis(analysis.clean, analysis.features, None, None, {"kpis": tables["kpis"]}, {})
        assert len(small.write(str(tmp_path / "marts"), "csv", mode)) == 2

"""Scale properties visible in the physical plans."""

from pyspark.sql import functions as F

from tabwatch.operators.histogram import histogram_open
from tabwatch.operators.profile import build_profile
from tabwatch.plans.feature_queries import labeled_docs
from tabwatch.plans.tables import NUM_FEATURES, lineitem_baseline, lineitem_new
from tabwatch.testing import plan_text

SF = "/root/testdata/sf0.01"


def test_histogram_scan_is_pruned_and_filtered(spark):
    prof = build_profile(lineitem_baseline(spark, SF), list(NUM_FEATURES), 10)
    plan = plan_text(histogram_open(lineitem_new(spark, SF), prof))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    read = [l for l in plan.splitlines() if l.startswith("ReadSchema")][0]
    assert "l_orderkey" not in read and "l_returnflag" not in read   # only used columns reach the scan
    assert "HashAggregate" in plan and "partial_count" in plan       # map-side combine


def test_document_text_is_never_read(spark):
    plan = plan_text(labeled_docs(spark, SF))
    reads = [l for l in plan.splitlines() if l.startswith("ReadSchema")]
    assert reads and all("text" not in l for l in reads)


def test_profile_is_a_local_relation(spark):
    prof = build_profile(lineitem_baseline(spark, SF), ["l_quantity"], 10)
    plan = plan_text(prof)
    assert "LocalTableScan" in plan and "Scan parquet" not in plan


def test_best_run_location_is_built_from_the_best_row(spark):
    import __spark_entry__ as E
    plan = plan_text(E.queries()["best_run_location"](spark, SF))
    assert "Join" not in plan and plan.count("Scan parquet") == 2     # the tree names it, and so do its details

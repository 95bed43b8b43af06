"""KPIs the reference specifies without any source data: fixture tests."""

from mercato.plans.kpis import manufacturing_kpis, source_variance


def test_manufacturing_kpis(spark):
    rows = [("B1", "S1", "P1", 100, 5, True, 200.0), ("B2", "S1", "P1", 100, 15, False, 300.0),
            ("B3", "S1", "P1", None, None, None, None), ("B4", "S2", "P9", 50, 0, True, 50.0)]
    df = spark.createDataFrame(rows, "batch_id string, supplier_id string, product_id string, units_produced int, "
                                     "units_defective int, qa_passed boolean, batch_cost double")
    got = {(r.supplier_id, r.product_id): r for r in manufacturing_kpis(df).collect()}
    r = got[("S1", "P1")]
    assert r.batches == 3 and r.defect_rate == 0.1 and r.qa_pass_rate == 0.5
    assert r.unit_batch_cost == 2.5 and abs(r.data_completeness - 2 / 3) < 1e-12
    assert got[("S2", "P9")].defect_rate == 0.0


def test_source_variance(spark):
    a = spark.createDataFrame([("2024-01", "Shopee", 100.0), ("2024-01", "Lazada", 200.0),
                               ("2024-02", "Shopee", 50.0)], "m string, ch string, v double")
    b = spark.createDataFrame([("2024-01", "Shopee", 101.0), ("2024-01", "Lazada", 190.0),
                               ("2024-03", "Shopee", 10.0)], "m string, ch string, v double")
    got = {(r.m, r.ch): (r.variance, r.variance_status) for r in source_variance(a, b, ["m", "ch"], "v").collect()}
    assert got[("2024-01", "Shopee")] == (1.0, "Reconciled")        # 1%
    assert got[("2024-01", "Lazada")] == (-10.0, "Review")          # exactly -5%: the Review edge
    assert got[("2024-02", "Shopee")] == (-50.0, "Investigate")     # missing in b
    assert got[("2024-03", "Shopee")] == (10.0, "Investigate")      # missing in a

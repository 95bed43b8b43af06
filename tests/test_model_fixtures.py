"""Edge cases of the model on hand-written landing tables (FIXTURES.md §3)."""

import datetime as dt

from fixture_raw import FixtureRaw, money, product
from mercato.operators.asof import asof_join
from mercato.plans.model import Model

D, TS = dt.date, dt.datetime
W = [("W1", " w1 ", " Main ", "Distribution Center", "SG", "SG", "Asia", "['SG', 'MY']")]


def _mv(mid, ts, typ, pid, q):
    return (mid, ts, typ, "W1", pid, q, "X", mid)


def inventory_model(spark):
    rows = {
        "warehouses": W,
        "products": [product("P1", D(2000, 1, 1)), product("P2", D(1999, 1, 1)),
                     product("P3", D(2000, 1, 3)), product("P4", D(1990, 1, 1), D(1994, 6, 1), status="Discontinued"),
                     product("P5", None), product("P6", D(2001, 1, 1))],
        "assignment": [("W1", p) for p in ("P1", "P2", "P3", "P4", "P5", "P6")],
        "inventory_snapshot": [("S1", D(2000, 1, 10), "W1", "P1", 100, 0, 100, 10, 20, money(0)),
                               ("S2", D(2000, 1, 10), "W1", "P2", 7, 0, 7, 10, 20, money(0))],
        "inventory_movements": [
            _mv("M1", TS(2000, 1, 5, 10), "INBOUND_PURCHASE", "P1", 20),
            _mv("M2", TS(2000, 1, 10, 9), "CUSTOMER_SALE", "P1", -5),       # on the snapshot day
            _mv("M3a", TS(2000, 1, 12, 8), "CUSTOMER_SALE", "P1", -30),     # same time, id decides
            _mv("M3b", TS(2000, 1, 12, 8), "CUSTOMER_RETURN", "P1", 10),
            _mv("M4", TS(2000, 1, 12, 12), "INBOUND_PURCHASE", "P1", 5),    # dips and recovers
            _mv("M5", TS(2000, 1, 4, 1), "INBOUND_PURCHASE", "P3", 3),
        ],
    }
    return Model(spark, raw=FixtureRaw(spark, rows), sim_start=D(2000, 1, 1), sim_end=D(2000, 1, 20))


def _days(a, b):
    d = a
    while d <= b:
        yield d
        d += dt.timedelta(days=1)


def test_inventory_daily_edge_cases(spark):
    m = inventory_model(spark)
    got = {(r.product_id, r.balance_date): (r.quantity_on_hand, r.units_sold_qty, r.units_returned_qty,
                                            r.units_received_qty)
           for r in m.fact_inventory_daily.collect()}
    want = {}
    for d in _days(D(2000, 1, 1), D(2000, 1, 20)):
        on = 85 if d < D(2000, 1, 5) else 105 if d < D(2000, 1, 10) else 100 if d < D(2000, 1, 12) else 85
        flows = {D(2000, 1, 5): (0, 0, 20), D(2000, 1, 10): (5, 0, 0), D(2000, 1, 12): (30, 10, 5)}
        want[("P1", d)] = (on,) + flows.get(d, (0, 0, 0))
        want[("P2", d)] = (7, 0, 0, 0)                     # snapshot, no movement
        if d >= D(2000, 1, 3):                             # no snapshot: offset 0
            want[("P3", d)] = (0 if d < D(2000, 1, 4) else 3, 0, 0, 3 if d == D(2000, 1, 4) else 0)
    assert got == want                                     # P4, P5, P6: no rows


def test_anchor_and_running_totals(spark):
    m = inventory_model(spark)
    off = {r.product_id: (r.cumulative_at_snapshot, r.opening_balance_offset) for r in m.balance_offset.collect()}
    assert off == {"P1": (15, 85), "P2": (0, 7)}
    rt = {r.movement_id: r.cumulative_qty_change for r in m.running_totals.collect()}
    assert rt == {"M1": 20, "M2": 15, "M3a": -15, "M3b": -5, "M4": 0, "M5": 3}
    # anchor check: the derived balance on the snapshot day equals the snapshot
    day = {r.product_id: r.quantity_on_hand for r in m.fact_inventory_daily.collect()
           if r.balance_date == D(2000, 1, 10)}
    assert day["P1"] == 100 and day["P2"] == 7


def test_inventory_levels_equal_dense(spark):
    m = inventory_model(spark)
    lv = {r.balance_date: (r.active_pairs, r.stockout_pairs, r.quantity_on_hand)
          for r in m.inventory_levels().collect()}
    dense = {}
    for r in m.fact_inventory_daily.collect():
        a, s, q = dense.get(r.balance_date, (0, 0, 0))
        dense[r.balance_date] = (a + 1, s + (r.quantity_on_hand <= 0), q + r.quantity_on_hand)
    assert lv == dense


def ar_model(spark, keep_partial=False):
    inv = [("I1", "O1", "C1", "NET30", D(2000, 1, 1), D(2000, 1, 31), money(100), money(0), None, "Open"),
           ("I2", "O2", "C1", "NET15", D(2000, 1, 1), D(2000, 1, 16), money(50), money(50), D(2000, 1, 10), "Paid"),
           ("I3", "O3", "C9", "NET15", D(2000, 1, 1), D(2000, 1, 16), money(80), money(30), D(2000, 1, 5),
            "Partially Paid"),
           ("I4", "O4", "C1", "NET60", D(2000, 5, 1), D(2000, 6, 30), money(10), money(0), None, "Open")]
    cust = [("C1", "A", "B", "a@b", "1", "SG", "F", None, D(1999, 1, 1), "Gold", "Referral", "Active")]
    return Model(spark, raw=FixtureRaw(spark, {"ar_invoices": inv, "customers": cust}),
                 sim_start=D(2000, 1, 1), sim_end=D(2000, 4, 5), keep_partial_payments=keep_partial)


def test_ar_aging(spark):
    m = ar_model(spark)
    rows = m.fact_ar_aging_daily.collect()
    by = {}
    for r in rows:
        by.setdefault(r.invoice_number, []).append(r)
    assert "I4" not in by                                          # dated after the end
    i1 = {r.days_outstanding: r for r in by["I1"]}
    assert len(i1) == 96 and min(i1) == 0 and max(i1) == 95         # open to the end
    for age, bucket in [(30, "aging_bucket_0_30_amount"), (31, "aging_bucket_31_60_amount"),
                        (60, "aging_bucket_31_60_amount"), (61, "aging_bucket_61_90_amount"),
                        (90, "aging_bucket_61_90_amount"), (91, "aging_bucket_90_plus_amount")]:
        r = i1[age]
        amounts = {b: getattr(r, b) for b in ("aging_bucket_0_30_amount", "aging_bucket_31_60_amount",
                                              "aging_bucket_61_90_amount", "aging_bucket_90_plus_amount")}
        assert amounts[bucket] == money(100) and sum(amounts.values()) == money(100)
    i2 = {r.snapshot_date: r.open_balance_amount for r in by["I2"]}
    assert max(i2) == D(2000, 1, 10) and i2[D(2000, 1, 9)] == money(50) and i2[D(2000, 1, 10)] == money(0)
    i3 = {r.snapshot_date: r.open_balance_amount for r in by["I3"]}
    assert max(i3) == D(2000, 1, 5) and i3[D(2000, 1, 5)] == money(50)   # rest vanishes (reference)
    assert {r.customer_key for r in by["I3"]} == {-1}                       # unknown customer
    kept = [r for r in ar_model(spark, keep_partial=True).fact_ar_aging_daily.collect() if r.invoice_number == "I3"]
    assert max(r.snapshot_date for r in kept) == D(2000, 4, 5)
    # the sweep equals the dense daily sum
    dense = {}
    for r in rows:
        dense[r.snapshot_date] = dense.get(r.snapshot_date, 0) + r.open_balance_amount
    lv = {r.snapshot_date: r.open_balance_amount for r in m.ar_balance_levels().collect()}
    assert lv == {d: v for d, v in dense.items() if v != 0}


def test_sales_and_returns_edges(spark):
    o = [("O1", "C1", TS(2000, 1, 1, 10), "Shopee", "Cash", "Delivered", "W1"),
         ("O2", "CX", TS(2000, 1, 2, 10), "Retail", "Cash", "Cancelled", "WX")]
    oi = [("OI1", "O1", "P1", "W1", 3, money(4), 0.0, money(10), money(0), money(10), money(0), money(0.6)),
          ("OI2", "O1", "PX", "W1", 2, money(5), 0.0, money(9.99), money(0), money(9.99), money(0), money(0)),
          ("OI3", "O2", "P1", "WX", 0, money(0), 0.0, money(0), money(0), money(0), money(0), money(0)),
          ("OI4", "O9", "P1", "W1", 1, money(1), 0.0, money(1), money(0), money(1), money(0), money(0))]
    rets = [("R1", "O1", "OI1", "S", "P1", "W1", TS(2000, 1, 5), 1, "Customer Remorse", "Restock"),
            ("R2", "O1", "OI-missing", "S", "P1", "W1", TS(2000, 1, 5), 1, "Damaged", "Dispose"),
            ("R3", "O2", "OI3", "S", "P1", "WX", TS(2000, 1, 5), 1, "Customer Remorse", "Restock"),
            ("R4", "O1", "OI2", "S", "PX", "W1", TS(2000, 1, 6), 1, "Damaged", "Refurbish"),
            ("R5", "O9", "OI4", "S", "P1", "W1", TS(2000, 1, 6), 1, "Damaged", "Refurbish")]
    inv = [("I1", "O1", "C1", "NET30", D(2000, 1, 2), D(2000, 2, 1), money(1), money(0), None, "Open")]
    cust = [("C1", "A", "B", "a@b", "1", "SG", "F", None, D(1999, 1, 1), "Gold", "Referral", "Active")]
    rows = {"orders": o, "order_items": oi, "returns": rets, "ar_invoices": inv, "customers": cust,
            "products": [product("P1", D(1999, 1, 1), cost="2.50")], "warehouses": W}
    m = Model(spark, raw=FixtureRaw(spark, rows))
    fs = {r.order_number + "/" + str(r.line_item_number): r for r in m.fact_sales.collect()}
    assert set(fs) == {"O1/1", "O1/2", "O2/1"}                 # line without header dropped
    assert fs["O1/2"].product_key == -1 and fs["O2/1"].customer_key == -1 and fs["O2/1"].warehouse_key == -1
    assert fs["O1/1"].payment_terms_code == "NET30" and fs["O2/1"].payment_terms_code == "DUE_ON_RECEIPT"
    assert fs["O1/1"].cogs_amount == money(7.5)
    fr = {r.return_authorization_number: r for r in m.fact_returns.collect()}
    assert set(fr) == {"R1", "R2", "R3", "R4"}                 # return without order header dropped
    assert (fr["R1"].refunded_amount, fr["R1"].restocking_fee_amount) == (money(3.33), money(0.33))
    assert fr["R2"].refunded_amount is None and fr["R2"].restocking_fee_amount == money(0)
    assert fr["R3"].refunded_amount is None and fr["R3"].restocking_fee_amount is None
    assert fr["R4"].refunded_amount == money(5.00)             # 4.995 rounds half up


def test_attribution_rules(spark):
    camps = spark.createDataFrame([("CMP-001", "TikTok", D(2024, 1, 2)), ("CMP-005", "TikTok", D(2024, 1, 6)),
                                   ("CMP-009", "TikTok", D(2024, 1, 6)), ("CMP-002", "Meta", D(2024, 1, 3))],
                                  "campaign_id string, channel string, start_date date")
    cust = spark.createDataFrame([("A", "TikTok", D(2024, 1, 2)), ("B", "TikTok", D(2024, 1, 1)),
                                  ("C", "Organic Search", D(2024, 1, 9)), ("D", "TikTok", D(2024, 1, 7)),
                                  ("E", "Meta", None)],
                                 "customer_id string, channel string, customer_since date")
    for plan in ("broadcast", "bucketed"):
        got = {r.customer_id: r.campaign_id for r in asof_join(
            cust, camps, ["channel"], "customer_since", "start_date", ["campaign_id"], tie=["campaign_id"],
            force=plan).collect()}
        assert got == {"A": "CMP-001", "B": None, "C": None, "D": "CMP-009", "E": None}, plan


def test_ar_bucket_sweep_equals_dense(spark):
    m = ar_model(spark)
    names = [n for n, _, _ in m.AGING_BUCKETS]
    dense = {}
    for r in m.fact_ar_aging_daily.collect():
        acc = dense.setdefault(r.snapshot_date, [0] * (len(names) + 1))
        for i, n in enumerate(names):
            acc[i] += getattr(r, n)
        acc[-1] += 1
    lv = {r.snapshot_date: [getattr(r, n) for n in names] + [r.open_rows] for r in m.ar_bucket_levels().collect()}
    assert lv == dense

"""Type-2 versions by gaps and islands, and lookups at a date."""

import datetime as dt
import random

import pytest

from mercato.plans.model import dim_date_frame
from mercato.plans.scd import as_of, interval_versions

D = dt.date
OPEN = D(9999, 12, 31)
SCHEMA = "k string, a string, b int, f date, t date, n int"


def versions(spark, rows, sequence="n"):
    out = interval_versions(spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], "f", "t", sequence)
    return sorted((r.k, r.a, r.b, r.valid_from, r.valid_to, r.is_current, r.version_number) for r in out.collect())


def test_equal_neighbours_merge_gaps_stay_and_sequence_orders_a_day(spark):
    rows = [("x", "A", 1, D(2024, 1, 1), D(2024, 1, 10), 1), ("x", "A", 1, D(2024, 1, 11), D(2024, 1, 20), 1),      # adjoin: merge
            ("x", "A", 1, D(2024, 1, 25), D(2024, 1, 26), 1),                                                      # gap
            ("x", "B", None, D(2024, 2, 1), None, 1), ("x", "C", None, D(2024, 2, 1), None, 2),                       # one day: the later
            ("x", "C", None, D(2024, 3, 1), None, 1),                                                              # open until here, the same
            ("y", None, None, D(2024, 1, 5), D(2024, 1, 5), 1), ("y", None, None, D(2024, 1, 6), None, 1), ("z", "n", 1, None, None, 1)]
    assert versions(spark, rows) == [
        ("x", "A", 1, D(2024, 1, 1), D(2024, 1, 20), False, 1), ("x", "A", 1, D(2024, 1, 25), D(2024, 1, 26), False, 2),
        ("x", "C", None, D(2024, 2, 1), OPEN, True, 3), ("y", None, None, D(2024, 1, 5), OPEN, True, 1)]
    assert versions(spark, []) == []


@pytest.mark.parametrize("rows, said", [
    ([("x", "A", 1, D(2024, 1, 1), D(2024, 1, 10), 1), ("x", "B", 1, D(2024, 1, 10), None, 1)], "overlapping or reversed"),
    ([("x", "A", 1, D(2024, 1, 9), D(2024, 1, 1), 1)], "overlapping or reversed")])
def test_what_is_no_history_fails(spark, rows, said):
    with pytest.raises(Exception, match=said):
        versions(spark, rows)


def test_unlike_observations_of_a_day_need_a_sequence(spark):
    rows = [("x", "A", 1, D(2024, 1, 1), None, 1), ("x", "B", 1, D(2024, 1, 1), None, 2)]
    with pytest.raises(Exception, match="unlike observations"):
        versions(spark, rows, None)
    assert versions(spark, [rows[0], rows[0]], None) == [("x", "A", 1, D(2024, 1, 1), OPEN, True, 1)]


def test_lookup_at_a_date_equals_brute_force(spark):
    random.seed(2)
    rows = []
    for k in "abc":
        at = D(2019, 11, 1)
        for _ in range(12):
            at += dt.timedelta(days=random.randrange(1, 200))
            until = at + dt.timedelta(days=random.randrange(0, 150))
            rows.append((k, random.choice("PQ"), 1, at, until, 1))
            at = until
    rows.append(("c", "Z", 1, D(2029, 1, 1), None, 1))
    v = interval_versions(spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "b"], "f", "t", "n")
    facts = [(i, random.choice("abcd"), D(2019, 1, 1) + dt.timedelta(days=random.randrange(4500))) for i in range(300)]
    facts.append((999, "a", None))
    got = {r.id: r.a for r in as_of(spark.createDataFrame(facts, "id int, k string, d date"), v, ["k"], "d", ["a"], dim_date_frame(spark, D(2019, 1, 1), D(2032, 12, 31))).collect()}
    want = {}
    for i, k, d in facts:
        hits = [a for kk, a, _, f, t, _ in rows if kk == k and d and f <= d and (t is None or d <= t)]
        want[i] = hits[0] if hits else None
    assert got == want and len(set(want.values())) == 4

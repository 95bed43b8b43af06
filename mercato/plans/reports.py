"""Report filters, comparison periods and sub-totals for the KPIs.

A :class:`Report` holds a date range, an optional comparison range and filters.
A filter is a semi join: the dimension rows that it keeps, reduced to their
keys, restrict the fact, so no fact row is multiplied and only filtered
dimensions are read. Both ranges are read in one pass over a fact: every sum is
taken once per period, and ratios are divided from the summed components.

A filter restricts the facts that it has a way to (:data:`WAYS`); on the others
it has no effect, as a control that does not apply to a chart. ``Report.scope``
says which.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.exprs import lit_date
from .dashboards import completed_orders
from .kpis import _ratio
from .model import Model

#: Values of a filter: a list, or a condition on the column.
Wanted = Sequence | Callable[[Column], Column]


def _keeps(column: Column, wanted: Wanted) -> Column:
    return wanted(column) if callable(wanted) else column.isin(*wanted)


def _products(m: Model, wanted: Wanted) -> DataFrame:
    return m.dim_product.where(_keeps(F.col("category_name"), wanted)).select("product_key")


def _supplied(m: Model, wanted: Wanted) -> DataFrame:
    of = m.stg("stg_products").where(_keeps(F.col("supplier_id"), wanted)).select("product_id")
    return m.dim_product.join(of, "product_id", "left_semi").select("product_key")


def _suppliers(m: Model, wanted: Wanted) -> DataFrame:
    return m.dim_supplier.where(_keeps(F.col("supplier_id"), wanted)).select("supplier_key")


def _warehouses(m: Model, wanted: Wanted) -> DataFrame:
    return m.dim_warehouse.where(_keeps(F.col("warehouse_id"), wanted)).select("warehouse_key")


def _customers(attribute: Callable[[], Column]) -> Callable[[Model, Wanted], DataFrame]:
    return lambda m, wanted: m.dim_customer.where(_keeps(attribute(), wanted)).select("customer_key")


def _campaigns(attribute: str) -> Callable[[Model, Wanted], DataFrame]:
    return lambda m, wanted: m.dim_campaign.where(_keeps(F.col(attribute), wanted)).select("campaign_key")


def _acquired(attribute: str) -> Callable[[Model, Wanted], DataFrame]:
    """Customers that campaigns of the attribute brought in."""
    def keys(m: Model, wanted: Wanted) -> DataFrame:
        found = _campaigns(attribute)(m, wanted).withColumnRenamed("campaign_key", "acquisition_campaign_key")
        return m.dim_customer.join(found, "acquisition_campaign_key", "left_semi").select("customer_key")
    return keys


def _orders(m: Model, wanted: Wanted) -> DataFrame:
    return m.stg("stg_orders").where(_keeps(F.col("sales_channel"), wanted)).select(F.col("order_id").alias("order_number"))


_COHORT = _customers(lambda: F.trunc("customer_since", "MM"))
_COUNTRY = _customers(lambda: F.col("customer_country"))
_BUYERS = {"country": ("customer_key", _COUNTRY), "cohort": ("customer_key", _COHORT),
           "acquisition_channel": ("customer_key", _acquired("acquisition_channel_name")), "platform": ("customer_key", _acquired("marketing_platform")),
           "campaign": ("customer_key", _acquired("campaign_id"))}
_GOODS = {"category": ("product_key", _products), "supplier": ("product_key", _supplied), "warehouse": ("warehouse_key", _warehouses)}

#: fact -> filter -> the fact's column and the keys that the filter keeps (None: the column itself is compared).
WAYS: dict[str, dict[str, tuple[str, Callable[[Model, Wanted], DataFrame] | None]]] = {
    "sales": {"channel": ("sales_channel_code", None), **_GOODS, **_BUYERS},
    "returns": {"channel": ("order_number", _orders), **_GOODS, **_BUYERS},
    "purchases": {"category": ("product_key", _products), "supplier": ("supplier_key", _suppliers), "warehouse": ("destination_warehouse_key", _warehouses)},
    "stock": _GOODS,
    "spend": {"acquisition_channel": ("campaign_key", _campaigns("acquisition_channel_name")), "platform": ("campaign_key", _campaigns("marketing_platform")),
              "campaign": ("campaign_key", _campaigns("campaign_id"))},
    "customers": _BUYERS,
}
FILTERS = sorted({name for ways in WAYS.values() for name in ways})


@dataclass
class Report:
    m: Model
    period: tuple[dt.date, dt.date]
    compare: tuple[dt.date, dt.date] | None = None
    filters: Mapping[str, Wanted] = field(default_factory=dict)

    def __post_init__(self):
        unknown = sorted(set(self.filters) - set(FILTERS))
        if unknown:
            raise ValueError(f"no such filter: {', '.join(unknown)}")

    def periods(self) -> dict[str, tuple[dt.date, dt.date]]:
        return {"current": self.period} | ({"previous": self.compare} if self.compare else {})

    def scope(self, fact: str) -> list[str]:
        """The filters that restrict ``fact``."""
        return [name for name in self.filters if name in WAYS[fact]]

    def restrict(self, fact: str, df: DataFrame) -> DataFrame:
        """The rows of a fact that the filters keep."""
        for name in self.scope(fact):
            column, keys = WAYS[fact][name]
            if keys is None:
                df = df.where(_keeps(F.col(column), self.filters[name]))
            else:
                kept = keys(self.m, self.filters[name]).toDF("_kept")
                df = df.join(kept, df[column] == kept["_kept"], "left_semi")
        return df

    def within(self, date: str) -> Column:
        """Days of either period."""
        out = F.lit(False)
        for a, b in self.periods().values():
            out = out | F.col(date).between(lit_date(a), lit_date(b))
        return out

    def sums(self, fact: str, df: DataFrame, date: str, measures: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
        """One row: every measure per period. A measure is an aggregate of the
        rows for which the condition that it is given holds."""
        rows = self.restrict(fact, df.where(self.within(date)))
        return rows.agg(*[measure(F.col(date).between(lit_date(a), lit_date(b))).alias(f"{name}__{period}")
                          for period, (a, b) in self.periods().items() for name, measure in measures.items()])

    # -- the components, one pass over each fact --------------------------------

    def sales(self) -> DataFrame:
        return self.sums("sales", self.m.fact_sales, "order_date", {
            "net_revenue": _sum("net_revenue_amount"), "cogs": _sum("cogs_amount"), "discounts": _sum("discount_amount"), "units_sold": _sum("quantity_ordered"),
            "completed_orders": lambda yes: F.count_distinct(F.when(yes & (F.col("fulfillment_status") != "Cancelled"), F.col("order_number")))})

    def returns(self) -> DataFrame:
        return self.sums("returns", self.m.fact_returns, "return_date", {"refunds": _sum("refunded_amount"), "units_returned": _sum("returned_quantity")})

    def purchases(self) -> DataFrame:
        late = F.to_date("actual_receipt_date") <= F.col("expected_date")
        return self.sums("purchases", self.m.fact_purchase_orders, "po_date", {
            "purchase_orders": lambda yes: F.count_if(yes), "units_ordered": _sum("ordered_quantity"), "units_received": _sum("received_quantity"),
            "received_on_time": lambda yes: F.count_if(yes & late), "received": lambda yes: F.count_if(yes & F.col("actual_receipt_date").isNotNull()),
            "price_variance": _sum("purchase_price_variance_amount")})

    def stock(self) -> DataFrame:
        """Pair-days with and without stock, from the intervals' overlap with the periods."""
        iv = self.restrict("stock", self.m.inventory_intervals)
        out = []
        for period, (a, b) in self.periods().items():
            days = F.greatest(F.datediff(F.least("valid_to", lit_date(b)), F.greatest("valid_from", lit_date(a))) + 1, F.lit(0)).cast("long")
            out += [F.sum(days).alias(f"pair_days__{period}"), F.sum(F.when(F.col("quantity_on_hand") <= 0, days)).alias(f"stockout_pair_days__{period}")]
        return iv.agg(*out)

    def spend(self) -> DataFrame:
        return self.sums("spend", self.m.fact_marketing_spend, "spend_date", {
            "spend": _sum("spend_amount"), "impressions": _sum("impressions_count"), "clicks": _sum("clicks_count")})

    def customers(self) -> DataFrame:
        known = self.m.dim_customer.where(F.col("customer_id") != C.UNKNOWN_ID)
        brought = F.col("acquisition_campaign_key") != C.UNKNOWN_KEY
        return self.sums("customers", known, "customer_since", {"new_customers": lambda yes: F.count_if(yes), "attributed_customers": lambda yes: F.count_if(yes & brought)})

    # -- the scorecard ------------------------------------------------------------

    def scorecard(self, facts: Sequence[str] = tuple(WAYS)) -> DataFrame:
        """(kpi, current_value, previous_value, change): the components and the
        ratios that the chosen facts give; an empty sum is 0, a ratio without
        a denominator NULL."""
        wide = None
        for fact in facts:
            row = getattr(self, fact)()
            wide = row if wide is None else wide.crossJoin(F.broadcast(row))     # one row each
        names = list(dict.fromkeys(c.split("__")[0] for c in wide.columns))
        ratios = {name: parts for name, parts in RATIOS.items() if set(parts) <= set(names)}

        def value(name: str, period: str) -> Column:
            if period not in self.periods():
                return F.lit(None).cast("double")
            if name in ratios:
                top, bottom = ratios[name]
                return _ratio(F.coalesce(f"{top}__{period}", F.lit(0)), F.coalesce(f"{bottom}__{period}", F.lit(0)))
            return F.coalesce(F.col(f"{name}__{period}").cast("double"), F.lit(0.0))

        rows = F.array(*[F.struct(F.lit(n).alias("kpi"), value(n, "current").alias("current_value"), value(n, "previous").alias("previous_value")) for n in [*names, *ratios]])
        return (wide.select(F.explode(rows).alias("r")).select("r.*")
                .withColumn("change", _ratio(F.col("current_value") - F.col("previous_value"), F.col("previous_value"))))


#: ratio -> numerator, denominator
RATIOS = {"average_order_value": ("net_revenue", "completed_orders"), "cost_share": ("cogs", "net_revenue"), "return_rate": ("units_returned", "units_sold"),
          "on_time_rate": ("received_on_time", "received"), "fill_rate": ("units_received", "units_ordered"), "stockout_rate": ("stockout_pair_days", "pair_days"),
          "cost_per_click": ("spend", "clicks"), "cac": ("spend", "attributed_customers")}


def _sum(column: str) -> Callable[[Column], Column]:
    return lambda yes: F.sum(F.when(yes, F.col(column)))


def margin_cube(m: Model, sets: Sequence[Sequence[str]], columns: Sequence[str] = ("category_name", "sales_channel_code", "order_month")) -> DataFrame:
    """Revenue, cost and units for each asked grouping set of category, channel
    and month. The facts are summed to the finest cells first, right where they
    met their product (cells by product are nearly as many as the lines); only
    these are expanded, and only to the sets that were asked for. ``grouping_level`` has a
    bit for every column that is summed over, the first column's highest."""
    lines = (m.fact_sales.where(F.col("order_date").between(lit_date(m.sim_start), lit_date(m.sim_end)))
             .select("product_key", "sales_channel_code", F.trunc("order_date", "MM").alias("order_month"),
                     "net_revenue_amount", "cogs_amount", "quantity_ordered"))
    named = lines.join(m.dim_product.select("product_key", "category_name"), "product_key").groupBy(*columns).agg(
        F.sum("net_revenue_amount").alias("net"), F.sum("cogs_amount").alias("cost"), F.sum("quantity_ordered").alias("units"))
    out = named.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.grouping_id(*[F.col(c) for c in columns]).cast("bigint").alias("grouping_level"), F.sum("net").cast("double").alias("net_revenue_amount"),
        F.sum("cost").cast("double").alias("cogs_amount"), F.sum("units").cast("bigint").alias("units"))
    return out.select(*columns, "grouping_level", "net_revenue_amount", "cogs_amount", "units")

"""Slowly changing dimensions, type 2, and point-in-time lookups.

:func:`interval_versions` builds a history from dated observations, :func:`as_of`
looks facts up in it. Three dimensions have one: the customer's loyalty tier
(re-derived every calendar year from that year's net spend), the product's
lifecycle and what a campaign lives on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import MONEY, composite, surrogate_key
from .model import Model

# Chosen values (not from the reference): yearly net spend thresholds of the
# loyalty tiers used to derive a tier history from the sales data.
TIER_THRESHOLDS = [("400000.00", "Platinum"), ("250000.00", "Gold"), ("100000.00", "Silver")]
TIER_ELSE = "Bronze"
OPEN_END = "9999-12-31"


def tier_of(spend: Column) -> Column:
    expr = None
    for lo, label in TIER_THRESHOLDS:
        cond = spend >= F.lit(lo).cast(MONEY)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(TIER_ELSE)


def interval_versions(obs: DataFrame, keys: Sequence[str], attrs: Sequence[str], start: str, end: str | None = None,
                      sequence: str | None = None, version_key: str = "version_key") -> DataFrame:
    """Type-2 versions from dated observations, by gaps and islands.

    An observation holds from ``start`` to ``end``, both days included; without
    an end (or with a NULL one) until the next observation of its key, or for
    ever. Neighbours that adjoin and say the same become one version, gaps stay
    gaps. Of several observations of one key that start on one day the highest
    ``sequence`` counts. What cannot be a history fails with its key: an end
    before the start or inside the next observation, and unlike observations of
    one day that no sequence orders.

    Columns: the keys and attributes, ``version_key``, ``valid_from``,
    ``valid_to``, ``is_current``, ``version_number``. A key has at most one
    observation a day after the first step (combined before the shuffle), so the
    windows hold at most the calendar's days.
    """
    keys, attrs = list(keys), list(attrs)
    name = F.to_json(F.struct(*keys))
    last = F.col(end) if end else F.lit(None).cast("date")
    rows = obs.select(*keys, F.col(start).alias("__from"), last.alias("__to"), F.struct(*attrs).alias("__what"),
                      (F.col(sequence) if sequence else F.lit(0)).alias("__seq")).where(F.col("__from").isNotNull())
    rank = F.struct("__seq", "__to", "__what")
    day = rows.groupBy(*keys, "__from").agg(
        F.max_by(F.struct("__to", "__what"), rank).alias("__r"), F.max("__seq").alias("__top"), *(
            [] if sequence else [F.min(F.struct("__to", "__what")).alias("__least"), F.max(F.struct("__to", "__what")).alias("__most")]))
    if not sequence:
        unlike = F.raise_error(F.concat(F.lit("unlike observations of one day: "), name))
        day = day.withColumn("__r", F.when(F.col("__least").eqNullSafe(F.col("__most")), F.col("__r")).otherwise(unlike))
    w = Window.partitionBy(*keys).orderBy("__from")
    following = F.lead("__from").over(w)
    bounded = day.select(*keys, "__from", "__r.*", following.alias("__next"))
    bad = (F.col("__to") < F.col("__from")) | (F.col("__to") >= F.col("__next"))
    closed = bounded.withColumn("__to", F.when(bad, F.raise_error(F.concat(F.lit("overlapping or reversed interval: "), name)))
                                .otherwise(F.coalesce("__to", F.date_sub("__next", 1), F.lit(OPEN_END).cast("date"))))
    goes_on = F.lag("__what").over(w).eqNullSafe(F.col("__what")) & (F.lag("__to").over(w) == F.date_sub("__from", 1))
    islands = (closed.withColumn("__new", F.when(goes_on, 0).otherwise(1))
               .withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    merged = islands.groupBy(*keys, F.col("__island").alias("version_number")).agg(
        F.first("__what").alias("__what"), F.min("__from").alias("valid_from"), F.max("__to").alias("valid_to"))
    return merged.select(
        surrogate_key(composite(*keys, F.col("valid_from").cast("string"))).alias(version_key), *keys, "__what.*",
        "valid_from", "valid_to", (F.col("valid_to") == F.lit(OPEN_END).cast("date")).alias("is_current"), "version_number")


def as_of(fact: DataFrame, versions: DataFrame, keys: Sequence[str], date: str, values: Sequence[str], calendar: DataFrame) -> DataFrame:
    """``fact`` with ``values`` of the version that held on ``date`` (NULL in a
    gap). Versions are cut into calendar years, so that a row meets the versions
    of its key and year only, by an equi-join that spreads a key with a long
    history; ``calendar`` (full_date) bounds the years of open versions."""
    limit = calendar.agg(F.year(F.max("full_date")).alias("__last"))       # one row
    parts = (versions.select(*keys, *values, "valid_from", "valid_to").crossJoin(F.broadcast(limit))
             .where(F.year("valid_from") <= F.col("__last"))
             .withColumn("__year", F.explode(F.sequence(F.year("valid_from"), F.least(F.year("valid_to"), F.col("__last"))))).drop("__last"))
    v = parts.select(*[F.col(k).alias(f"__{k}") for k in keys], "__year", *[F.col(c).alias(f"__v_{c}") for c in values], "valid_from", "valid_to")
    on = F.year(fact[date]) == v["__year"]
    for k in keys:
        on = on & (fact[k] == v[f"__{k}"])
    on = on & fact[date].between(v["valid_from"], v["valid_to"])
    joined = fact.join(v, on, "left")
    return joined.select(*[fact[c] for c in fact.columns], *[v[f"__v_{c}"].alias(c) for c in values])


def customer_tier_history(m: Model) -> DataFrame:
    fs = m.fact_sales.filter(F.col("customer_key") != -1)
    yearly = (fs.groupBy("customer_key", F.year("order_date").alias("year"))
              .agg(F.sum("net_revenue_amount").alias("spend"))
              .select("customer_key", F.make_date("year", F.lit(1), F.lit(1)).alias("year_start"),
                      tier_of(F.col("spend")).alias("loyalty_tier")))
    dc = m.dim_customer.select("customer_key", "customer_id")
    return interval_versions(yearly.join(dc, "customer_key"), ["customer_id"], ["loyalty_tier"], "year_start", version_key="customer_version_key")


def sales_by_tier_at_order(m: Model) -> DataFrame:
    """Point-in-time lookup: each sale takes the tier valid on its order date."""
    fs = m.fact_sales.join(m.dim_customer.select("customer_key", "customer_id"), "customer_key")
    j = as_of(fs.select("customer_id", "order_date", "net_revenue_amount"), customer_tier_history(m), ["customer_id"], "order_date", ["loyalty_tier"], m.dim_date)
    return (j.groupBy(F.year("order_date").alias("order_year"),
                      F.coalesce("loyalty_tier", F.lit("Unranked")).alias("loyalty_tier"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount")))


def one_current_version(m: Model) -> DataFrame:
    h = customer_tier_history(m)
    per = h.groupBy("customer_id").agg(F.count(F.when(F.col("is_current"), 1)).alias("current_versions"))
    return per.agg(F.count(F.lit(1)).alias("customers"),
                   F.count(F.when(F.col("current_versions") != 1, 1)).alias("violations"))


def campaign_mix_history(m: Model) -> DataFrame:
    """Type-2 history of what a campaign lives on, from its days: clicks, views
    or both alike. Days without spend are gaps."""
    days = m.stg("stg_marketing_spend").select("campaign_id", "date", F.when(F.col("clicks") > F.col("impressions"), "Click-led")
                                               .when(F.col("clicks") < F.col("impressions"), "View-led").otherwise("Balanced").alias("campaign_mix"))
    return interval_versions(days.withColumn("until", F.col("date")), ["campaign_id"], ["campaign_mix"], "date", "until", version_key="campaign_version_key")


def spend_by_mix(m: Model) -> DataFrame:
    """Campaign spend by the mix that held on the day before (point in time)."""
    spend = m.stg("stg_marketing_spend").select("campaign_id", F.date_sub("date", 1).alias("day_before"), "spend_sgd")
    j = as_of(spend, campaign_mix_history(m), ["campaign_id"], "day_before", ["campaign_mix"], m.dim_date)
    return (j.groupBy(F.coalesce("campaign_mix", F.lit("No Spend")).alias("mix_of_the_day_before"))
            .agg(F.count(F.lit(1)).alias("days"), F.sum("spend_sgd").cast("double").alias("spend_amount")))


def history_checks(m: Model) -> DataFrame:
    """Per history: versions, keys, overlaps, adjoining versions that say the
    same, repeated version keys and keys with more than one current version."""
    parts = []
    for label, history, key, attr, version in (("customer", customer_tier_history(m), "customer_id", "loyalty_tier", "customer_version_key"),
                                               ("product", product_lifecycle_history(m), "product_id", "lifecycle_status", "product_version_key"),
                                               ("campaign", campaign_mix_history(m), "campaign_id", "campaign_mix", "campaign_version_key")):
        w = Window.partitionBy(key).orderBy("valid_from")
        before = history.withColumn("_to", F.lag("valid_to").over(w)).withColumn("_what", F.lag(attr).over(w))
        per = before.groupBy(key).agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("valid_from") <= F.col("_to")).alias("overlaps"),
            F.count_if((F.col("valid_from") == F.date_add("_to", 1)) & F.col("_what").eqNullSafe(F.col(attr))).alias("unmerged"),
            F.count_if(F.col("valid_from") > F.date_add("_to", 1)).alias("gaps"), F.count_if("is_current").alias("current"))
        keys = history.groupBy(version).count().agg(F.count_if(F.col("count") > 1).alias("repeated_keys"))
        parts.append(per.agg(F.lit(label).alias("dimension"), F.sum("n").alias("versions"), F.count(F.lit(1)).alias("members"), F.sum("gaps").alias("gaps"),
                             F.sum("overlaps").alias("overlaps"), F.sum("unmerged").alias("unmerged"), F.count_if(F.col("current") > 1).alias("several_current"))
                     .crossJoin(F.broadcast(keys)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def product_lifecycle_history(m: Model) -> DataFrame:
    """Type-2 history of the product lifecycle: 'New Launch' from the launch
    date, 'Active' one year later, 'Discontinued' from the discontinuation
    date (a change on or before an earlier one replaces it)."""
    p = m.dim_product.filter(F.col("product_id") != "UNKNOWN").filter(F.col("launch_date").isNotNull())
    obs = p.select("product_id", F.explode(F.array(
        F.struct(F.col("launch_date").alias("d"), F.lit(0).alias("o"), F.lit("New Launch").alias("s")),
        F.struct(F.date_add("launch_date", 365).alias("d"), F.lit(1).alias("o"), F.lit("Active").alias("s")),
        F.struct(F.col("discontinued_date").alias("d"), F.lit(2).alias("o"), F.lit("Discontinued").alias("s"))))
        .alias("e")).select("product_id", "e.*").filter(F.col("d").isNotNull())
    # A later stage that starts on or before an earlier stage's start wins it.
    obs = (obs.withColumn("__later_min", F.min("d").over(
        Window.partitionBy("product_id").orderBy(F.desc("o")).rowsBetween(Window.unboundedPreceding, -1)))
        .filter(F.col("__later_min").isNull() | (F.col("d") < F.col("__later_min"))))
    return interval_versions(obs.select("product_id", F.col("d").alias("change_date"), F.col("s").alias("lifecycle_status")),
                             ["product_id"], ["lifecycle_status"], "change_date", version_key="product_version_key")


def sales_by_lifecycle_at_order(m: Model) -> DataFrame:
    fs = m.fact_sales.join(m.dim_product.select("product_key", "product_id"), "product_key")
    j = as_of(fs.select("product_id", "order_date", "net_revenue_amount"), product_lifecycle_history(m), ["product_id"], "order_date", ["lifecycle_status"], m.dim_date)
    return (j.groupBy(F.coalesce("lifecycle_status", F.lit("Before Launch")).alias("lifecycle_status_at_order"))
            .agg(F.count(F.lit(1)).alias("lines"),
                 F.sum("net_revenue_amount").cast("double").alias("net_revenue_amount")))

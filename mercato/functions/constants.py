"""Fixed values of the business domain.

Fixed values: these must stay equal to the retail model they come from
(channel names and classes, commission rates, payment terms, return reasons,
dispositions, holidays, attribution channels). Listed plainly, in natural order.
"""

from __future__ import annotations

import datetime as dt

# --- fixed values -----------------------------------------------------------

# Sales channel -> channel class used by the channel-mix reports.
CHANNEL_CLASS = {
    "Shopify": "Web",
    "Retail": "Retail Boutique",
    "Shopee": "Marketplace",
    "Lazada": "Marketplace",
}
CHANNEL_CLASS_DEFAULT = "Other"

# Marketplace commission on net sales, by channel (others pay none).
COMMISSION_RATE = {"Shopee": "0.06", "Lazada": "0.05"}

# Credit terms and their days.
PAYMENT_TERMS_DAYS = {"NET15": 15, "NET30": 30, "NET60": 60}
DEFAULT_PAYMENT_TERMS = "DUE_ON_RECEIPT"

# Return reasons and dispositions.
RETURN_REASONS = ["Sizing Issue", "Damaged", "Not as Expected",
                  "Customer Remorse", "Wrong Item"]
DISPOSITIONS = ["Restock", "Refurbish", "Liquidate", "Dispose"]
RESTOCKING_FEE_REASON = "Customer Remorse"
RESTOCKING_FEE_RATE = "0.10"

# Movement types of the inventory ledger.
MOVEMENT_SALE = "CUSTOMER_SALE"
MOVEMENT_RETURN = "CUSTOMER_RETURN"
MOVEMENT_PURCHASE = "INBOUND_PURCHASE"

# Holidays flagged in the calendar (month, day).
HOLIDAYS = [(1, 1), (12, 25), (9, 9), (10, 10), (11, 11), (12, 12)]

# Paid acquisition channels and their platforms; Organic Search is unpaid.
PAID_CHANNELS = ["Facebook Ads", "Instagram", "TikTok", "Email Campaign"]
CHANNEL_PLATFORM = {"Facebook Ads": "Meta", "Instagram": "Meta",
                    "TikTok": "TikTok", "Email Campaign": "Klaviyo"}

# Demand tiers: right-closed percentile-rank bins 0/.50/.80/.95/1.
DEMAND_TIERS = [(0.50, "Low"), (0.80, "Medium"), (0.95, "High"), (1.00, "Very High")]

# KPI status thresholds.
GROSS_MARGIN_STATUS = [(0.45, "On Target"), (0.35, "Watch")]
GROSS_MARGIN_STATUS_ELSE = "Below Target"
LTV_CAC_STATUS = [(3.0, "Healthy"), (1.5, "Marginal")]
LTV_CAC_STATUS_ELSE = "Unprofitable"

# Unknown / no-campaign members of the dimensions.
UNKNOWN_KEY = -1
UNKNOWN_ID = "UNKNOWN"
NO_CAMPAIGN_ID = "NO_CAMPAIGN"

# --- mapping of the driver's test tables onto the retail domain -------------

# Order priority -> sales channel; '4-NOT SPECIFIED' maps to a channel outside
# the class map so that the 'Other' class is exercised.
PRIORITY_CHANNEL = {
    "1-URGENT": "Shopify",
    "2-HIGH": "Shopee",
    "3-MEDIUM": "Lazada",
    "4-NOT SPECIFIED": "Wholesale",
    "5-LOW": "Retail",
}
ORDER_STATUS = {"F": "Delivered", "O": "Shipped", "P": "Cancelled"}
PAYMENT_METHODS = ["Credit Card", "Digital Wallet", "Bank Transfer", "Cash on Delivery"]
SEGMENT_CHANNEL = {
    "HOUSEHOLD": "Organic Search",
    "FURNITURE": "Facebook Ads",
    "MACHINERY": "Instagram",
    "BUILDING": "TikTok",
    "AUTOMOBILE": "Email Campaign",
}
# Customers of this segment buy on credit terms and receive AR invoices.
CREDIT_SEGMENT = "BUILDING"
PRIORITY_TERMS = {
    "1-URGENT": "NET15",
    "2-HIGH": "NET15",
    "3-MEDIUM": "NET30",
    "4-NOT SPECIFIED": "NET30",
    "5-LOW": "NET60",
}
# Marketing: k of the event props picks the paid channel; a channel runs one
# campaign after another, each for CAMPAIGN_DAYS days.
CAMPAIGN_DAYS = 10
# The events are dated this many years after the first orders; shifted back by
# it, every contact (sign-up, view, click) lies on the clock of the orders.
EVENT_YEARS_BACK = 29
# Odd step between the keys of one entity's daily snapshot rows.
DAY_STEP = 0x9E3779B97F

# Time frame of the model.
SIM_START = dt.date(1995, 1, 1)
SIM_END = dt.date(2001, 12, 31)
CALENDAR_START = dt.date(1994, 1, 1)
CALENDAR_END = dt.date(2024, 12, 31)
AS_OF = dt.date(2001, 6, 30)          # PO cut-off and "sellable" reference day
SNAPSHOT_DATE = dt.date(1998, 1, 1)   # physical stock count
PRODUCT_COST_RATIO = "0.60"           # unit cost = 60% of list price
PO_COST_RATIO = "0.58"                # purchase price = 58% of unit selling price
PO_LEAD_DAYS = 30
SAFETY_STOCK = 10
DISCONTINUED_MIN_SIZE = 48            # part sizes >= this are discontinued
NEW_LAUNCH_FROM = dt.date(2001, 1, 1)

"""Fixed lookup values: city spellings, label maps and the sale calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# Fixed values. City: (province, tier, lower-case spellings seen for it).
CITIES = {
    "Karachi": ("Sindh", 1, ("karachi", "khi", "karachi, sindh")),
    "Lahore": ("Punjab", 1, ("lahore", "lhr", "lahore cantt")),
    "Islamabad": ("Islamabad Capital Territory", 1, ("islamabad", "isb", "islamabad capital territory")),
    "Rawalpindi": ("Punjab", 1, ("rawalpindi", "pindi", "rwp", "rawalpindi cantt")),
    "Faisalabad": ("Punjab", 2, ("faisalabad", "fsd")),
    "Multan": ("Punjab", 2, ("multan",)),
    "Peshawar": ("Khyber Pakhtunkhwa", 2, ("peshawar", "pesh")),
    "Hyderabad": ("Sindh", 2, ("hyderabad", "hyd", "hyderabad, sindh")),
    "Gujranwala": ("Punjab", 2, ("gujranwala", "grw")),
    "Sialkot": ("Punjab", 2, ("sialkot", "skt")),
    "Quetta": ("Balochistan", 3, ("quetta",)),
    "Bahawalpur": ("Punjab", 3, ("bahawalpur", "bwp")),
    "Sukkur": ("Sindh", 3, ("sukkur",)),
    "Abbottabad": ("Khyber Pakhtunkhwa", 3, ("abbottabad", "abbotabad")),
    "Sargodha": ("Punjab", 3, ("sargodha",)),
    "Mardan": ("Khyber Pakhtunkhwa", 3, ("mardan",)),
}

# Fixed values. Standard label: lower-case labels that mean it.
PAYMENT_METHODS = {
    "Cash on Delivery": ("cod", "cash on delivery", "cash_on_delivery"),
    "Card": ("card", "cc"),
    "Mobile Wallet": ("jazzcash", "easypaisa", "wallet"),
}
PAYMENT_GROUPS = {"COD": ("cod", "cash on delivery", "cash_on_delivery")}
DEFAULT_PAYMENT_GROUP = "Prepaid"
ORDER_STATUSES = {
    "Delivered": ("dlvd", "delivered"),
    "Cancelled": ("cncl", "cancelled", "canceled"),
    "Returned to Origin": ("rto", "returned_to_origin"),
    "In Transit": ("shpd", "shipped"),
}
CATEGORIES = {
    "Fashion": ("fashion",),
    "Footwear": ("footwear",),
    "Electronics": ("electronics",),
    "Mobile Accessories": ("mobile accessories",),
    "Home & Kitchen": ("home & kitchen",),
    "Beauty & Personal Care": ("beauty & personal care",),
    "Grocery": ("grocery",),
    "Baby & Toys": ("baby & toys",),
}
CHANNELS = {
    "Paid Social": ("paid social", "facebook ads", "instagram ads"),
    "Organic Search": ("organic search", "organic", "google organic"),
    "App Store": ("app store", "app_store"),
}
NO_PROMO = ("", "NONE")

# Religious and sale dates that explain peaks in daily orders.
SEASONS = (
    ("Ramadan", "2024-03-12", "2024-04-09"),
    ("Ramadan", "2025-03-02", "2025-03-30"),
    ("Ramadan", "2026-02-19", "2026-03-20"),
    ("Eid ul Fitr", "2024-04-10", "2024-04-10"),
    ("Eid ul Fitr", "2025-03-31", "2025-03-31"),
    ("Eid ul Fitr", "2026-03-21", "2026-03-21"),
    ("Independence Day Sale", "2024-08-14", "2024-08-14"),
    ("11.11 Mega Sale", "2024-11-11", "2024-11-11"),
    ("White Friday", "2024-11-29", "2024-11-29"),
    ("12.12 Sale", "2024-12-12", "2024-12-12"),
    ("Independence Day Sale", "2025-08-14", "2025-08-14"),
    ("11.11 Mega Sale", "2025-11-11", "2025-11-11"),
    ("White Friday", "2025-11-28", "2025-11-28"),
    ("12.12 Sale", "2025-12-12", "2025-12-12"),
)


def _listed(spark: SparkSession, rows, columns: str) -> DataFrame:
    """Rows written out in the plan, so that the optimizer knows how many there are."""
    def literal(v) -> str:
        if isinstance(v, dt.date):
            return f"DATE '{v.isoformat()}'"
        return str(v) if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS listed({columns})")


def city_map(spark: SparkSession) -> DataFrame:
    """A2: one row per known spelling, pointing at the real city, its province and its tier."""
    rows = [(spelling, city, province, tier)
            for city, (province, tier, spellings) in CITIES.items() for spelling in spellings]
    return _listed(spark, rows, "raw_key, city, province, city_tier")


def calendar(spark: SparkSession, seasons=SEASONS) -> DataFrame:
    """Named date ranges, both ends included."""
    rows = [(name, dt.date.fromisoformat(a), dt.date.fromisoformat(b)) for name, a, b in seasons]
    return _listed(spark, rows, "event, starts, ends")

"""Column expressions shared by operators and plans. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Reporting zone of the retail plans.
ZONE = "Asia/Kolkata"
#: Ordered category rules; the first whose tags overlap wins.
CATEGORY_RULES = (
    ("Tea, Coffee & Breakfast", ("en:teas", "en:tea", "en:coffees", "en:instant-coffees", "en:breakfast-cereals", "en:mueslis", "en:oat-flakes", "en:honeys")),
    ("Dairy, Bread & Eggs", ("en:milks", "en:dairies", "en:cheeses", "en:yogurts", "en:butters", "en:ghee", "en:breads", "en:eggs", "en:paneer", "en:dairy-desserts")),
    ("Atta, Rice & Dal", ("en:flours", "en:wheat-flours", "en:rices", "en:legumes", "en:pulses", "en:lentils", "en:chickpeas", "en:semolinas", "en:cereal-grains")),
    ("Instant & Frozen Food", ("en:instant-noodles", "en:noodles", "en:frozen-foods", "en:pastas", "en:soups", "en:meals", "en:ready-meals", "en:pickles", "en:sauces")),
    ("Cold Drinks & Juices", ("en:sodas", "en:juices", "en:fruit-juices", "en:waters", "en:energy-drinks", "en:carbonated-drinks", "en:plant-based-beverages", "en:beverages")),
    ("Snacks & Munchies", ("en:snacks", "en:salty-snacks", "en:sweet-snacks", "en:chips-and-fries", "en:biscuits", "en:cookies", "en:chocolates", "en:confectioneries", "en:nuts", "en:namkeen")),
)


def local_ts(ts: Column, zone: str = ZONE) -> Column:
    return F.from_utc_timestamp(ts.cast("timestamp"), zone)


def local_date(ts: Column, zone: str = ZONE) -> Column:
    return F.to_date(local_ts(ts, zone))


def minutes_between(start: Column, finish: Column) -> Column:
    """Minutes as DOUBLE, by whole milliseconds; null if either end is."""
    ms = F.timestamp_diff("MILLISECOND", start.cast("timestamp"), finish.cast("timestamp"))
    return ms / F.lit(60000.0)


def week_start(day: Column) -> Column:
    """The Monday of a date's week."""
    return F.trunc(day, "week")


def ratio(a: Column, b: Column) -> Column:
    """a / b as DOUBLE, null for a zero or null divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def optional_col(df: DataFrame, name: str, kind: str) -> Column:
    """The column cast to ``kind``, or a typed null while the table does not have it yet."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)


def clean_text(c: Column, limit: int = 200) -> Column:
    """White space collapsed, trimmed, cut to ``limit``; null if nothing is left."""
    out = F.substring(F.trim(F.regexp_replace(c.cast("string"), r"\s+", " ")), 1, limit)
    return F.when(out != "", out)


def category_of(tags: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, needles in reversed(CATEGORY_RULES):
        out = F.when(F.arrays_overlap(tags, F.array(*(F.lit(n) for n in needles))), name).otherwise(out)
    return out


def first_en_tag(tags: Column) -> Column:
    return F.substring(F.get(F.filter(tags, lambda x: x.startswith("en:")), F.lit(0)), 1, 80)


def distinct_from(a: list[Column], b: list[Column]) -> Column:
    """Null-safe inequality of two rows of columns."""
    out = F.lit(False)
    for x, y in zip(a, b, strict=True):
        out = out | ~x.eqNullSafe(y)
    return out

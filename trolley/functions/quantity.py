"""Column functions on quantities, prices and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

S = r"[\s\u00a0]*"
END = r"(?![A-Za-z0-9_])"
NUMBER = r"[0-9]+(?:[.,][0-9]+)?"
UNIT = "kg|g|l|ml|cl"
#: Patterns of a quantity, of a range that gives none, and of a pack (below).
QUANTITY = rf"(?i)([0-9]+){S}x{S}({NUMBER}){S}({UNIT}){END}|({NUMBER}){S}({UNIT}){END}"
RANGE = rf"(?i)(?:{NUMBER}{S}-{S}{NUMBER}|[<>+]{S}{NUMBER}){S}(?:{UNIT}){END}"
START = r"(?<![A-Za-z0-9_])"
PACK = rf"(?i){START}pack{S}(?:de{S})?([0-9]+){END}|{START}([0-9]+){S}un(?:idades?)?{END}"
TOLERANCE = 0.05
UNIT_PRICE_TOLERANCE = 0.15


def without_ranges(name: Column) -> Column:
    return F.regexp_replace(name, RANGE, " ")


def without_first_quantity(c: Column) -> Column:
    return F.regexp_replace(c, f"(?s)^(.*?)(?:{QUANTITY})", "$1 ")


def _number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def _scale(unit: Column) -> Column:
    unit = F.lower(unit)
    return F.when(unit.isin("kg", "l"), 1000.0).when(unit == "cl", 10.0).otherwise(1.0)


def parse_quantity(name: Column) -> Column:
    """struct<qty double, kind string, multiplier int> of the first quantity in g or ml; null if none.

    Weight ranges that name a size ("9-15kg") do not count.
    """
    s = without_ranges(name)
    part = [F.regexp_extract(s, QUANTITY, i) for i in range(6)]
    packed = part[1] != ""
    unit = F.when(packed, part[3]).otherwise(part[5])
    number = F.when(packed, _number(part[1]) * _number(part[2])).otherwise(_number(part[4]))
    kind = F.when(F.lower(unit).isin("kg", "g"), "weight").otherwise("volume")
    times = F.when(packed, part[1].try_cast("int")).otherwise(1)
    return F.when(
        part[0] != "",
        F.struct((number * _scale(unit)).alias("qty"), kind.alias("kind"), times.alias("multiplier")),
    )


def extract_quantity(name: Column) -> Column:
    """struct<value double, unit string> in g or ml; null if none."""
    q = parse_quantity(name)
    unit = F.when(q["kind"] == "weight", "g").otherwise("ml")
    return F.when(q.isNotNull(), F.struct(q["qty"].alias("value"), unit.alias("unit")))


def proxy_quantity(price: Column, unit_price: Column) -> Column:
    """price / unit price (kind ``proxy``) where both are not zero."""
    proxy = F.struct(
        F.round(F.try_divide(price.cast("double"), unit_price.cast("double")), 4).alias("qty"),
        F.lit("proxy").alias("kind"),
        F.lit(1).alias("multiplier"),
    )
    return F.when((price != 0) & (unit_price != 0), proxy)


def quantity_or_proxy(name: Column, price: Column, unit_price: Column) -> Column:
    """The quantity in the name, else the proxy."""
    return F.coalesce(parse_quantity(name), proxy_quantity(price, unit_price))


def qty_matches(a: Column, b: Column, scale: bool = True) -> Column:
    """Within 5 %; both unknown match, one unknown does not. A proxy is per kg or litre and is scaled."""

    def scaled(x: Column, other: Column) -> Column:
        if not scale:
            return x["qty"]
        return F.when((x["kind"] == "proxy") & other["kind"].isin("weight", "volume"), x["qty"] * 1000).otherwise(x["qty"])

    qa, qb = scaled(a, b), scaled(b, a)
    near = F.coalesce(F.try_divide(F.abs(qa - qb), F.greatest(qa, qb)) <= TOLERANCE, F.lit(False))
    comparable = (a["kind"] == b["kind"]) | (a["kind"] == "proxy") | (b["kind"] == "proxy")
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(comparable & near)


def pack_count(name: Column) -> Column:
    times = F.regexp_extract(name, QUANTITY, 1)
    n = F.coalesce(F.nullif(F.regexp_extract(name, PACK, 1), F.lit("")), F.nullif(F.regexp_extract(name, PACK, 2), F.lit("")))
    return F.coalesce(F.nullif(times, F.lit("")), n).try_cast("int")


def price_changed(previous: Column, new: Column) -> Column:
    cents = lambda c: c.cast("decimal(12,2)")
    return previous.isNull() | (cents(previous) != cents(new))


def unit_price_ratio(a: Column, b: Column) -> Column:
    return F.when((a > 0) & (b > 0), F.greatest(a, b) / F.least(a, b) - 1)


def safe_unit_price(a: Column, b: Column) -> Column:
    return F.coalesce(unit_price_ratio(a, b) <= UNIT_PRICE_TOLERANCE, F.lit(False))


def target_threshold(price: Column) -> Column:
    return F.when(price > 40, 0.03).otherwise(0.05)


def drop_share(base: Column, now: Column) -> Column:
    return F.try_divide(base - now, base)


def whole_percent(share: Column) -> Column:
    """Half up, as displayed."""
    return F.floor(share * 100 + 0.5).cast("long")


def jaccard(a: Column, b: Column) -> Column:
    """Of token sets; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def trigrams(c: Column) -> Column:
    """Trigram set of the words, each with two blanks before and one behind."""
    words = F.filter(F.split(F.lower(c), "[^a-z0-9à-öø-ÿ]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(
        padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))
    )
    return F.array_distinct(F.flatten(grams))


def similarity(a: Column, b: Column) -> Column:
    return jaccard(trigrams(a), trigrams(b))

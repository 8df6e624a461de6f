"""Column functions: SKU forms, dirty text, dates, classes and ratios. All are Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_or_null(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(ratio_or_null(a, b), F.lit(0.0))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def normal_sku(c: Column) -> Column:
    """ITEM-COLOR-SIZE with blanks cut and colour and size in upper case; null is ''.

    Text without a dash stays; a blank item gives ''; without a colour both dashes stay; a size may hold dashes.
    """
    text = F.trim(F.coalesce(c, F.lit("")))
    parts = F.split(text, "-", -1)
    item, color = F.trim(parts[0]), F.upper(F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))))
    size = F.upper(F.trim(F.array_join(F.slice(parts, F.lit(3), F.size(parts)), "-")))
    whole = F.when((size == "") & (color != ""), F.concat_ws("-", item, color)).otherwise(F.concat_ws("-", item, color, size))
    return F.when(F.instr(text, "-") == 0, text).when(item == "", F.lit("")).otherwise(whole)


def make_sku(item: Column, color: Column, size: Column) -> Column:
    """From its parts: a size without a colour keeps both dashes."""
    i, c, s = (F.upper(F.trim(F.coalesce(x, F.lit("")))) for x in (item, color, size))
    return F.when(i == "", F.lit("")).when((c == "") & (s == ""), i).when(s == "", F.concat_ws("-", i, c)).otherwise(F.concat_ws("-", i, c, s))


def sku_part(c: Column, k: int) -> Column:
    return F.regexp_extract(c, r"^([^-]+)-([^-]+)-?(.*)$", k)


def clean_text(c: Column) -> Column:
    """Blanks collapsed; the words for nothing are null."""
    text = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(~F.lower(text).isin("", "nan", "none", "null", "nat", "n/a"), F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1"))


def to_number(c: Column) -> Column:
    """Currency, percent and bracketed text as a number; (5) is -5; a percent sign does not scale."""
    text = F.regexp_replace(F.trim(c), r"[$,%\s]", "")
    return F.regexp_replace(text, r"^\((.*)\)$", "-$1").try_cast("double")


def max_percent(c: Column) -> Column:
    """The largest whole percentage from 0 to 100 that a text names."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"(\d{1,3})(?:\.\d+)?\s*%"), F.lit(1)), lambda x: x.cast("int"))
    return F.array_max(F.filter(found, lambda x: x.between(0, 100)))


def unit_discount(c: Column) -> Column:
    """A discount above 1 is a percentage; the result is between 0 and 1."""
    return clip(F.when(c > 1, c / 100).otherwise(c), 0.0, 1.0)


def inferred_date(month: Column, day: Column) -> Column:
    """Without a year, months from July on are of 2025 and others of 2026; an impossible day is null."""
    year = F.when(month >= 7, 2025).otherwise(2026)
    return F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, day), F.lit("yyyy-MM-dd")))


def scope_tags(c: Column, words: tuple[str, ...]) -> Column:
    """The given words that a text holds, in the given order, joined by a bar."""
    return F.array_join(F.filter(F.array(*[F.when(F.contains(F.lower(c), F.lit(w.lower())), F.lit(w)) for w in words]), lambda x: x.isNotNull()), "|")


def velocity_tier(units13: Column) -> Column:
    """The tier of 13 weeks' units; names and limits are fixed values."""
    return F.when(units13.isNull() | (units13 <= 20), "C").when(units13 <= 40, "B").when(units13 <= 100, "A").otherwise("AA")


def newness(day: Column, go_live: Column) -> Column:
    """How new a SKU is on a day; names and limits are fixed values."""
    age = F.datediff(day, go_live)
    return F.when(age.isNull(), "UnknownGoLive").when(age < 0, "PreGoLive").when(age <= 30, "New0To30").when(age <= 90, "New31To90").otherwise("Established")


def freeze_class(file_date: Column, origin: Column) -> Column:
    late = F.datediff(file_date, origin)
    return F.when(late.isNull(), "unknown").when(late < 0, "clean_frozen").when(late == 0, "same_day").otherwise("late")


def promo_multiplier(is_promo: Column, discount: Column) -> Column:
    """1 without a promotion; 1.25 for one without a discount; else 1 + 0.75 of the discount; between 1 and 2."""
    return F.when(~is_promo, 1.0).when(F.coalesce(discount, F.lit(0.0)) <= 0, 1.25).otherwise(clip(1 + F.least(discount, F.lit(1.0)) * 0.75, 1.0, 2.0))


#: The bands' labels and their right-closed edges. The first edge is open below.
BANDS = ("<5%", "5-15%", "15-25%", "25-35%", "35-50%", "50-70%", "70%+")
BAND_EDGES = (-0.001, 0.0499, 0.1499, 0.2499, 0.3499, 0.4999, 0.6999, 1.0)


def discount_band(c: Column) -> Column:
    """The band of a discount share; none is 0, and a share outside of the edges has no band."""
    share = F.coalesce(c, F.lit(0.0))
    out = F.when(share <= BAND_EDGES[0], F.lit(None).cast("string"))
    for edge, name in zip(BAND_EDGES[1:], BANDS):
        out = out.when(share <= edge, name)
    return out


def same_day_of_year(day: Column, years: int) -> Column:
    """The same day some years on; 29 February becomes the 28th."""
    return F.add_months(day, 12 * years)


def offer_code(c: Column) -> Column:
    """Item and colour of an offer code; null unless it has both. A third part is left out."""
    text = F.upper(F.regexp_replace(c, r"\s+", ""))
    m = r"^([A-Z0-9]+)-([A-Z0-9]+)(?:-.*)?$"
    return F.when(text.rlike(m), F.struct(F.regexp_extract(text, m, 1).alias("Item"), F.regexp_extract(text, m, 2).alias("Color")))


#: Profiles of the sellable floor, locations and a zone whose stock is not sold, profiles and zones of reserve.
FLOOR_PROFILES = ("Picking", "Picking A", "PalletPicking")
UNSOLD_LOCATIONS, UNSOLD_ZONE = ("Washed", "Rags", "Quality"), "Quarantine"
RESERVE_PROFILES, RESERVE_ZONES = ("Bulk", "Overflow"), ("Bulk", "OVFLO")


def _stripped(*columns: Column) -> list[Column]:
    return [F.trim(F.coalesce(c, F.lit(""))) for c in columns]


def supply_class(trans_type: Column, template: Column, location: Column, profile: Column, zone: Column) -> Column:
    """What kind of supply a piece of work is; labels are fixed values. For returns stock that is not sold comes before the floor."""
    location, profile, zone = _stripped(location, profile, zone)
    template = F.coalesce(template, F.lit(""))
    unsold = location.isin(*UNSOLD_LOCATIONS) | (zone == UNSOLD_ZONE)
    returned = F.when(unsold, "ReturnNonSellable").when(profile.isin(*FLOOR_PROFILES), "ReturnToSellableFloor").otherwise("ReturnOther")
    received = F.when(template == "Active Putaway", "ActivePutaway").when(F.contains(template, F.lit("Cubiscan")), "CubiscanPutaway").otherwise("ReceivingPutaway")
    other = F.when(trans_type == 11, "Replenishment").when(trans_type == 7, "Transfer").otherwise("OtherSupplyWork")
    return F.when(trans_type == 12, returned).when(trans_type == 1, received).otherwise(other)


def destination_class(location: Column, profile: Column, zone: Column) -> Column:
    """Where work brings stock; labels are fixed values and the first rule that holds counts."""
    location, profile, zone = _stripped(location, profile, zone)
    reserve = profile.isin(*RESERVE_PROFILES) | zone.isin(*RESERVE_ZONES)
    staging = F.contains(F.upper(profile), F.lit("STAGE")) | F.contains(F.upper(zone), F.lit("STAGE")) | location.startswith("RSTAGE")
    return (
        F.when(location.isin(*UNSOLD_LOCATIONS) | (zone == UNSOLD_ZONE), "NonSellable")
        .when(profile.isin(*FLOOR_PROFILES), "SellableFloor").when(reserve, "ReserveOrBulk").when(staging, "Staging").otherwise("Other")
    )


def reservation_bucket(location: Column, profile: Column) -> Column:
    """The bucket of reserved stock; labels and profiles are fixed values, a blank location comes first."""
    return (
        F.when(F.coalesce(location, F.lit("")) == "", "BlankLocation").when(profile.isin("Picking", "Picking A", "Picking D", "PalletPicking"), "PickFace")
        .when(profile == "W001", "W001").when(profile.isin(*RESERVE_PROFILES), "ReserveOrBulk")
        .when(profile.isin("RSTAGE", "Induction", "Direct Packing"), "StagingOrProcessing").otherwise("OtherLocated")
    )

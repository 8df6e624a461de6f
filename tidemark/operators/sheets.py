"""Sheets as tables of cells (file_id, sheet_name, rw, cl, val): headers, header rows, kinds of sheets, records; and dates in file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clean_text

SHEET = ["file_id", "sheet_name"]
#: What header keys are worth; a row of at least 7 is a header row.
SCORES = {"offer": 5, "style": 3} | dict.fromkeys(("division", "department", "description", "color", "promo_price", "markdown_price", "mkd_price",
    "original_msrp", "pct_off_msrp", "inventory", "avail_inv"), 1)
LEAST_SCORE, FIRST_ROWS = 7, 35
#: Keys under which a header may stand, and the key it has.
ALIASES = {"markdown_pct_off_msrp": "pct_off_msrp", "original_msrp_": "original_msrp", "orig_msrp": "original_msrp", "avail_inv_": "avail_inv", "dept": "department",
    "exec": "exec_view", "style_id": "style"}
#: The labels of a sheet's event and of its dates.
EVENT_LABELS, DATE_LABELS = ("event_name",), ("effective_date_s",)


def header_key(c: Column, aliases: dict[str, str]) -> Column:
    """A label in snake case: signs become words, an alias its key; blank stays blank."""
    text = F.lower(F.coalesce(clean_text(c), F.lit("")))
    for sign, word in (("%", " pct "), ("&", " and "), ("$", " dollar ")):
        text = F.replace(text, F.lit(sign), F.lit(word))
    text = F.btrim(F.regexp_replace(text, "[^a-z0-9]+", "_"), F.lit("_"))
    out = F.when(F.lit(False), "")
    for a, b in aliases.items():
        out = out.when(text == a, b)
    return out.otherwise(text)


def keyed(cells: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Cells with their header key, told apart within a row: a second one ends in _2; blank cells are unnamed by their column."""
    key = header_key(F.col("val"), aliases)
    rows = cells.withColumn("key", F.when(key == "", F.concat(F.lit("unnamed_"), (F.col("cl") + 1).cast("string"))).otherwise(key))
    n = F.row_number().over(Window.partitionBy(*SHEET, "rw", "key").orderBy("cl"))
    return rows.withColumn("n", n).withColumn("header", F.when(F.col("n") == 1, F.col("key")).otherwise(F.concat_ws("_", "key", "n")))


def header_rows(cells: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(file_id, sheet_name, header_row, score) of sheets that have one: the first row with the best score."""
    worth = F.coalesce(*[F.when(F.col("header") == k, F.lit(v)) for k, v in SCORES.items()], F.lit(0))
    scores = keyed(cells.where(F.col("rw") < FIRST_ROWS), aliases).groupBy(*SHEET, "rw").agg(F.sum(worth).alias("score"))
    best = scores.groupBy(*SHEET).agg(F.max(F.struct("score", (-F.col("rw")).alias("r"))).alias("x"))
    return best.where(F.col("x.score") >= LEAST_SCORE).select(*SHEET, (-F.col("x.r")).alias("header_row"), "x.score")


def label_values(cells: DataFrame, labels: tuple[str, ...], aliases: dict[str, str], name: str) -> DataFrame:
    """(file_id, sheet_name, name): the first cell that is not blank to the right of the first such label."""
    full = cells.where(F.trim("val") != "")
    w = Window.partitionBy(*SHEET, "rw").orderBy("cl")
    rows = full.withColumn("next", F.lead("val").over(w)).where(header_key(F.col("val"), aliases).isin(*labels) & F.col("next").isNotNull())
    return rows.groupBy(*SHEET).agg(F.min_by("next", F.struct("rw", "cl")).alias(name))


def sheet_kind(sheet: Column, event: Column, has_header: Column, file: Column | None = None) -> Column:
    """What a sheet is, by words in the names of its file, itself and its event; labels are fixed values and the first rule that holds counts."""
    text = F.lower(F.concat_ws(" ", *([] if file is None else [F.coalesce(file, F.lit(""))]), sheet, F.coalesce(event, F.lit(""))))
    has = lambda *words: F.greatest(*[F.contains(text, F.lit(w)) for w in words], F.lit(False))
    without = F.when(has("roll up", "pivot"), "rollup_or_pivot").when(has("marketing dropdown") | (F.lower(F.trim(sheet)) == "data"),
        "support").otherwise("non_offer")
    return (
        F.when(has("coupon"), "coupon").when(has("tier 1") & has("recommend", "pin"), "tier1_recommendation").when(has("revision", "correction"),
            "correction").when(~has_header, without)
        .when(has("0% offer", "0 percent offer"), "zero_percent_offers").when(has("final sale"), "final_sale").when(has("markdown", "mkd", "further"),
            "markdown").when(has("badge"), "badge")
        .when(F.lower(sheet).startswith("promo offers") | has("all promo discount"), "aggregate_promo_offers").when(has("price change", "msrp"),
            "price_change").otherwise("promo_detail")
    )


def records(cells: DataFrame, aliases: dict[str, str], columns: list[str]) -> DataFrame:
    """(file_id, sheet_name, rw, columns): the rows below each sheet's header row, a column for each header; a row counts with an offer or style.

    A missing style is the offer's first part.
    """
    heads = header_rows(cells, aliases).select(*SHEET, "header_row")
    named = keyed(cells, aliases).join(heads, SHEET)
    keys = named.where("rw = header_row").select(*SHEET, "cl", "header")
    below = named.where("rw > header_row").select(*SHEET, "rw", "cl", F.trim("val").alias("val")).join(keys, [*SHEET, "cl"])
    rows = below.groupBy(*SHEET, "rw").agg(*[F.coalesce(F.max(F.when(F.col("header") == c, F.col("val"))), F.lit("")).alias(c) for c in columns])
    rows = rows.where("(offer <> '' or style <> '') and lower(offer) <> 'offer'")
    return rows.withColumn("style", F.when(F.col("style") == "", F.element_at(F.split("offer", "-"), 1)).otherwise(F.col("style")))


def try_date(year: Column, month: Column, day: Column) -> Column:
    """The date, null where there is none."""
    return F.to_date(F.try_to_timestamp(F.format_string("%04d-%02d-%02d", year, month, day), F.lit("yyyy-MM-dd")))


DATE = r"(?<![0-9])([0-9]{1,2})[/.-]([0-9]{1,2})(?:[/.-]([0-9]{2,4}))?(?![0-9])"


def date_range(text: Column, year: Column) -> Column:
    """struct(first, last) of the first two dates (month, day, perhaps year) in a text; one date is both.

    Without a year the first is of ``year``, and the second of the first one's year, or of the year after where it would lie before the
    first. A first date that is none gives nulls; a second one that is none is left out.
    """
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(DATE), F.lit(0))
    part = lambda x, k: F.regexp_extract(x, DATE, k)
    written = lambda x: F.when(part(x, 3) != "", F.when(F.length(part(x, 3)) == 2, part(x, 3).cast("int") + 2000).otherwise(part(x, 3).cast("int")))
    day = lambda x, y: try_date(F.coalesce(written(x), y), part(x, 1).cast("int"), part(x, 2).cast("int"))

    def pair(x: Column) -> Column:
        first = day(F.get(x, F.lit(0)), year)
        second = F.get(x, F.lit(1))
        last = day(second, F.year(first))
        last = F.when((part(second, 3) == "") & (last < first), F.coalesce(day(second, F.year(first) + 1), first)).otherwise(last)
        return F.struct(first.alias("first"), F.when(first.isNotNull(), F.coalesce(last, first)).alias("last"))

    # the dates are found once, however often they are asked for
    return F.get(F.transform(F.array(found), pair), F.lit(0))


def seen_from(days: Column, file_date: Column) -> Column:
    """A range in January or February that a file of the last quarter names, and that would lie long before it, is of the year after."""
    late = (F.month(file_date) >= 10) & (F.month(days["first"]) <= 3) & (days["first"] < file_date)
    later = lambda c: F.when(late, F.add_months(c, 12)).otherwise(c)
    return F.struct(later(days["first"]).alias("first"), later(days["last"]).alias("last"))


def sheet_events(cells: DataFrame, files: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """A record for each sheet: its file, height, width, header row, kind, event and dates; ``files`` has file_id, source_file, file_date.

    Dates come from the cell beside their label, or, where that has none, from the sheet's own name.
    """
    sheets = cells.groupBy(*SHEET).agg((F.max("rw") + 1).alias("height"), (F.max("cl") + 1).alias("width"))
    for found in (label_values(cells, EVENT_LABELS, aliases, "event"), label_values(cells, DATE_LABELS, aliases, "dates"), header_rows(cells, aliases).drop("score")):
        sheets = sheets.join(found, SHEET, "left")
    rows = sheets.join(files, "file_id", "left")
    year = F.year("file_date")
    own, named = seen_from(date_range(F.col("dates"), year), F.col("file_date")), seen_from(date_range(F.col("sheet_name"), year), F.col("file_date"))
    rows = rows.withColumns({"_own": own, "_named": named})
    days = F.when(F.col("_own.first").isNotNull(), F.col("_own")).otherwise(F.col("_named"))
    kind = sheet_kind(F.col("sheet_name"), F.col("event"), F.col("header_row").isNotNull(), F.col("source_file"))
    return rows.select(*SHEET, "source_file", "height", "width", "header_row", "event", F.trim("dates").alias("dates"), days["first"].alias("start_date"), days["last"].alias("end_date"),
        kind.alias("kind"))


def dates_in_name(name: Column, modified: Column) -> Column:
    """All dates that a file name may mean, nearest to the file's own first; that one alone where it means none."""
    part = lambda x, p, k: F.regexp_extract(x, p, k).cast("int")
    iso, mdy = r"(20\d{2})[-_.](\d{1,2})[-_.](\d{1,2})", r"(?<!\d)(\d{1,2})[._-](\d{1,2})[._-](\d{2,4})(?!\d)"
    one = F.transform(F.regexp_extract_all(name, F.lit(iso), F.lit(0)), lambda x: try_date(part(x, iso, 1), part(x, iso, 2), part(x, iso, 3)))
    year = lambda y: F.when(y < 100, y + 2000).otherwise(y)
    two = F.transform(F.regexp_extract_all(name, F.lit(mdy), F.lit(0)), lambda x: try_date(year(part(x, mdy, 3)), part(x, mdy, 1), part(x, mdy, 2)))

    def compact(x: Column) -> Column:
        y, body = F.right(x, F.lit(2)).cast("int") + 2000, F.substr(x, F.lit(1), F.length(x) - 2)
        at = lambda n: try_date(y, F.coalesce(F.substr(body, F.lit(1), F.length(body) - n).try_cast("int"), F.lit(0)),
            F.right(body, F.lit(n)).cast("int"))
        return F.when(F.length(body) >= 2, F.array(at(2), at(1))).otherwise(F.array().cast("array<date>"))

    three = F.flatten(F.transform(F.regexp_extract_all(name, F.lit(r"(?<!\d)(\d{3,6})(?!\d)"), F.lit(1)), compact))
    found = F.array_distinct(F.array_compact(F.concat(one, two, three)))
    found = F.when(F.size(found) == 0, F.array(modified)).otherwise(found)
    return F.transform(F.array_sort(F.transform(found, lambda d: F.struct(F.abs(F.datediff(d, modified)).alias("far"), d.alias("d")))), lambda x: x["d"])

"""Record extraction: parsed report blocks -> formatted ads (+ quarantine),
formatted -> typed clean ads, and the page jobs H1-H9.

Each ad is handled on its own (per-record extraction), so one incomplete ad
goes to quarantine instead of rejecting the file (the reference's positional
zip, see ``quality.positional_formatted`` for the strict/compat forms).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import markup as M
from ..functions import text as X

# URL path segment (0-based over split('/')) holding the city:
# https://ss.lv/msg/lv/real-estate/flats/<region>/<city>/<hash>.html
CITY_SEGMENT = 8

# formatted column -> (report label, prefix written in the formatted table)
FORMATTED_FIELDS = [
    ("Room_count", H.LABEL_ROOMS, "Istabas:>"),
    ("Size_sq_m", H.LABEL_SIZE, "Platiba:>"),
    ("Floor", H.LABEL_FLOOR, "Stavs:>"),
    ("Street", H.LABEL_STREET, "Iela:>"),
    ("Price", H.LABEL_PRICE, "Price:>"),
    ("Pub_date", H.LABEL_DATE, "Date:>"),
]


def _missing_reason() -> F.Column:
    checks = [F.when(F.col("url").isNull(), F.lit("no_url"))]
    checks += [F.when(F.col("_v_" + name).isNull(), F.lit("missing:" + label))
               for name, label, _ in FORMATTED_FIELDS]
    return F.coalesce(*checks)


def blocks_to_formatted(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """D2 -> D3. Returns (formatted rows with source columns, quarantine).

    Formatted values keep their label prefix, with the accent-free names
    ``Platiba`` / ``Stavs`` as the reference writes them.
    """
    # core fields by one anchored regex each; the all-labels MAP is only
    # carried along, so filters never inline its construction
    values = parsed.select("*", *[H.label_value("block", label).alias("_v_" + name)
                                  for name, label, _ in FORMATTED_FIELDS])
    tagged = values.withColumn("_reason", _missing_reason())
    good = tagged.where(F.col("_reason").isNull())
    formatted = good.select(
        F.col("url").alias("URL"),
        *[F.concat(F.lit(prefix), F.col("_v_" + name)).alias(name)
          for name, label, prefix in FORMATTED_FIELDS],
        "fields", "source_file", "run_date")
    quarantine = tagged.where(F.col("_reason").isNotNull()).select(
        "source_file", "block", F.col("_reason").alias("reason"), "run_date")
    return formatted, quarantine


def _tag(values: DataFrame, run, city_index: int, lift: F.Column, pre_reason: F.Column | None,
         block: F.Column) -> DataFrame:
    """Field strings (``_room _size _floor _street _price _date``) -> typed
    ads with one ``_reason`` column (NULL for a clean ad)."""
    street = F.regexp_replace(F.col("_street"), r"^(?:Iela:>)?(?:<[^>]*>)*", "")
    typed = values.select(
        F.col("url"),
        X.url_hash("url").alias("url_hash"),
        X.url_path_part("url", city_index).alias("city"),
        F.trim(F.col("_room")).alias("room_label"),
        F.trim(F.col("_room")).try_cast("int").alias("room_count"),
        X.apt_floor("_floor").alias("apt_floor"),
        X.house_floors("_floor").alias("house_floors"),
        lift.alias("has_lift"),
        X.normalise_street(street).alias("street"),
        X.parse_source_date(F.trim(F.col("_date"))).alias("pub_date"),
        X.parse_size("_size").alias("size_sqm"),
        X.parse_price_total("_price").alias("price_eur"),
        X.parse_price_per_sqm("_price").alias("sqm_price_eur"),
        run.alias("run_date"),
        F.col("source_file"),
        block.alias("_block"),
        (pre_reason if pre_reason is not None else F.lit(None).cast("string")).alias("_pre"))
    reason = F.coalesce(
        F.col("_pre"),
        F.when(F.col("url_hash").isNull(), F.lit("bad_url")),
        F.when(F.col("price_eur").isNull(), F.lit("bad_price")),
        F.when(F.col("size_sqm").isNull(), F.lit("bad_size")),
        F.when(F.col("apt_floor").isNull() | F.col("house_floors").isNull(), F.lit("bad_floor")),
        F.when(F.col("pub_date").isNull(), F.lit("bad_date")))
    # the raw block is only kept where a quarantine may need it
    return typed.withColumn("_reason", reason).withColumn(
        "_block", F.when(F.col("_reason").isNotNull() | F.col("run_date").isNull(), F.col("_block"))).drop("_pre")


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean ads, quarantine) from a tagged table. On a pinned tagged table
    the two filters are cheap; on a lazy one the optimizer pushes them into
    the parsing, so a job that needs both outputs should pin first (see
    ``plans.daily.run_report``)."""
    clean = tagged.where(F.col("_reason").isNull()).drop("_reason", "_block", "source_file")
    quarantine = tagged.where(F.col("_reason").isNotNull()).select(
        "source_file", F.col("_block").alias("block"), F.col("_reason").alias("reason"), "run_date")
    return clean, quarantine


def clean_formatted(formatted: DataFrame, run_date=None, city_index: int = CITY_SEGMENT) -> tuple[DataFrame, DataFrame]:
    """D3 -> (clean ads, quarantine); see ``formatted_to_tagged_ads``."""
    return split_tagged(formatted_to_tagged_ads(formatted, run_date, city_index))


def formatted_to_tagged_ads(formatted: DataFrame, run_date=None, city_index: int = CITY_SEGMENT) -> DataFrame:
    """D3 -> typed ads with a quarantine reason.

    F1 removes every label token from the seven formatted columns; rows whose
    price, size, floor or date do not parse go to quarantine with a reason
    (V6) instead of failing the run.
    """
    cols = [name for name, _, _ in FORMATTED_FIELDS]
    stripped = formatted.select(
        F.col("URL").alias("url"), X.has_lift("Floor").alias("_lift"),
        *[X.strip_tokens(F.col(c)).alias(c) for c in cols],
        F.col("source_file") if "source_file" in formatted.columns else F.lit(None).cast("string").alias("source_file"),
        F.col("run_date") if "run_date" in formatted.columns else F.lit(None).cast("date").alias("run_date"),
        F.concat_ws("\n", "URL", *cols).alias("_src_block"))
    renamed = stripped.select("url", "_lift", "source_file", "run_date", "_src_block",
                              *[F.col(c).alias(v) for c, v in zip(cols, _VALUE_COLS)])
    run = F.col("run_date") if run_date is None else X.run_date_lit(run_date)
    return _tag(renamed, run, city_index, F.col("_lift"), None, F.col("_src_block"))


_VALUE_COLS = ["_room", "_size", "_floor", "_street", "_price", "_date"]


def report_to_clean_ads(blocks: DataFrame, run_date=None, city_index: int = CITY_SEGMENT) -> tuple[DataFrame, DataFrame]:
    """S1 output -> (clean ads, quarantine); see ``report_to_tagged_ads``."""
    return split_tagged(report_to_tagged_ads(blocks, run_date, city_index))


def report_to_tagged_ads(blocks: DataFrame, run_date=None, city_index: int = CITY_SEGMENT) -> DataFrame:
    """S1 output -> (clean ads, quarantine) in one lazy plan: each core field
    by one anchored regex (H10), then F2-F10 on the bare values. The label
    prefixes are never added, so the F1 token strip is not needed here (the
    lift marker is read from the floor value, a leading tag is dropped from
    the street); the result equals D3 -> F1 -> typed, which the formatted
    path (``clean_formatted``) still does."""
    values = blocks.select(
        H.block_url("block").alias("url"), "block", "source_file", "run_date",
        *[H.label_value("block", label).alias(v) for (_, label, _), v in zip(FORMATTED_FIELDS, _VALUE_COLS)])
    missing = F.coalesce(F.when(F.col("url").isNull(), F.lit("no_url")),
                         *[F.when(F.col(v).isNull(), F.lit("missing:" + label))
                           for (_, label, _), v in zip(FORMATTED_FIELDS, _VALUE_COLS)])
    run = F.col("run_date") if run_date is None else X.run_date_lit(run_date)
    return _tag(values, run, city_index, F.coalesce(X.has_lift("_floor"), F.lit(False)), missing, F.col("block"))


def cleaned_csv_to_clean_ads(cleaned: DataFrame, run_date, city_index: int = CITY_SEGMENT) -> DataFrame:
    """S3 table (reference's cleaned CSV) -> typed clean ads."""
    run = X.run_date_lit(run_date)
    return cleaned.select(
        F.col("URL").alias("url"), X.url_hash("URL").alias("url_hash"),
        X.url_path_part("URL", city_index).alias("city"),
        F.trim("Room_count").alias("room_label"),
        F.trim("Room_count").try_cast("int").alias("room_count"),
        X.apt_floor("Floor").alias("apt_floor"), X.house_floors("Floor").alias("house_floors"),
        X.has_lift("Floor").alias("has_lift"), X.normalise_street("Street").alias("street"),
        X.parse_source_date("Pub_date").alias("pub_date"),
        F.col("Size_sqm").try_cast("decimal(10,2)").alias("size_sqm"),
        F.col("Price_in_eur").try_cast("double").try_cast("bigint").alias("price_eur"),
        F.col("SQ_meter_price").try_cast("decimal(10,2)").alias("sqm_price_eur"),
        run.alias("run_date"))


# --- pages (H1-H9) ------------------------------------------------------------

def page_links(pages: DataFrame, base: str = H.LINK_BASE, pattern: str = H.LINK_PATTERN) -> DataFrame:
    """H1+H2: (page_id, link_pos, url), first occurrence per page, order kept."""
    return pages.select("page_id", F.posexplode(H.msg_links("html", base, pattern)).alias("pos", "url")) \
        .select("page_id", (F.col("pos") + 1).alias("link_pos"), "url")


def distinct_links(pages: DataFrame, base: str = H.LINK_BASE, pattern: str = H.LINK_PATTERN) -> DataFrame:
    """Links over all pages once each, with the number of pages
    that carry them (pages repeat, so distinct is needed)."""
    return (page_links(pages, base, pattern).groupBy("url")
            .agg(F.count(F.lit(1)).alias("n_pages")))


def page_cells(pages: DataFrame, tag: str, cls: str, scoped: bool = False) -> DataFrame:
    """H4+H6: (page_id, cell_pos, text) for every matching cell."""
    return pages.select("page_id", F.posexplode(H.cells("html", tag, cls, scoped)).alias("pos", "text")) \
        .select("page_id", (F.col("pos") + 1).alias("cell_pos"), "text")


def ad_pages_to_blocks(pages: DataFrame, url_col: str = "url") -> tuple[DataFrame, DataFrame]:
    """H4-H9 on ad pages -> report blocks (K12 form) and quarantine.

    An ad without a price cell or without a footer date is quarantined
    (the reference skips the rest of the ad, or repeats the previous date).
    """
    def read(main):
        names, values, prices, footer = (M.cells(main, "td", c) for c in
                                         (H.CLASS_OPT_NAME, H.CLASS_OPT_VALUE, H.CLASS_PRICE, H.CLASS_FOOTER))
        lines = F.transform(F.filter(H.zip_options(names, values), lambda p: p["value"].isNotNull()),
                            lambda p: F.concat(p["name"], F.lit(">"), p["value"]))
        return F.struct(lines.alias("lines"), H.first_price(prices).alias("price"), H.footer_date(footer).alias("date"))

    def main(page):
        return M.bind(F.coalesce(M.element(page, "table", "id", H.MAIN_TABLE_ID), page), read)

    # one row a page out of a generator: no filter moves below it, so a page
    # is read once whatever is asked of it
    df = pages.select(F.col(url_col).alias("url"), F.inline(F.array(M.bind(M.tokens("html"), main))))
    block = F.concat_ws("\n", F.col("url"), F.array_join("lines", "\n"),
                        F.concat(F.lit("Price:>"), F.col("price")), F.concat(F.lit("Date:>"), F.col("date")))
    reason = F.coalesce(F.when(F.col("price").isNull(), F.lit("no_price")),
                        F.when(F.col("date").isNull(), F.lit("no_date")))
    tagged = df.withColumn("block", block).withColumn("reason", reason)
    return (tagged.where(F.col("reason").isNull()).select("url", "block"),
            tagged.where(F.col("reason").isNotNull()).select("url", "reason"))

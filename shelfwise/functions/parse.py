"""Column functions that turn scraped text into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column, default: float | None = 0.0) -> Column:
    """Price text of any locale as double.

    Only digits, dots and commas count. With both separators the later one is
    the decimal point; a lone comma is one when exactly two digits follow it.
    """
    c = F.regexp_replace(value.cast("string"), r"[^0-9.,]", "")
    has_dot, has_comma = F.contains(c, F.lit(".")), F.contains(c, F.lit(","))
    tail = F.reverse(c)
    dot_is_later = F.instr(tail, ".") < F.instr(tail, ",")
    no_commas = F.replace(c, F.lit(","), F.lit(""))
    plain = (
        F.when(has_dot & has_comma & dot_is_later, no_commas)
        .when(has_dot & has_comma,
              F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(c.rlike(r"^[0-9]*,[0-9]{2}$"), F.replace(c, F.lit(","), F.lit(".")))
        .otherwise(no_commas)
    )
    number = plain.try_cast("double")
    return number if default is None else F.coalesce(number, F.lit(float(default)))


def integer(value: Column, default: int | None = 0) -> Column:
    """Integer text with thousands commas as long; decimals do not count as integers."""
    c = F.trim(F.replace(value.cast("string"), F.lit(","), F.lit("")))
    number = F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("bigint"))
    return number if default is None else F.coalesce(number, F.lit(default).cast("bigint"))


def percent_off(original: Column, current: Column) -> Column:
    """Discount in percent, 1 decimal; null unless ``original > current > 0``."""
    return F.when((original > current) & (current > 0),
                  F.round((original - current) / original * 100, 1))


def _named_entities() -> Column:
    """Map of the HTML standard's entity names to their characters, from Python's own table."""
    from html.entities import html5

    cells = [F.lit(x) for name, char in sorted(html5.items()) if name.endswith(";") for x in (name[:-1], char)]
    return F.create_map(*cells)


def decode_entities(text: Column) -> Column:
    """Named and numeric character references replaced by their characters; unknown ones stay.

    Each distinct reference of a text is looked up once. An ampersand comes
    last, so that what it uncovers is not decoded again.
    """
    names = _named_entities()

    def char(reference: Column) -> Column:
        body = F.regexp_extract(reference, "^&([^;]*);", 1)
        number = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 9), 16, 10)).otherwise(
            F.substring(body, 2, 9)).cast("bigint")
        valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        return F.when(body.startswith("#"), F.when(valid, point)).otherwise(F.try_element_at(names, body))

    found = F.array_distinct(F.regexp_extract_all(
        text, F.lit(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"), F.lit(0)))
    pairs = F.transform(found, lambda r: F.struct((char(r) == "&").alias("last"), r.alias("r"), char(r).alias("c")))
    known = F.array_sort(F.filter(pairs, lambda x: x["c"].isNotNull()))
    decoded = F.aggregate(known, text, lambda t, x: F.replace(t, x["r"], x["c"]))
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)


def strip_html(html: Column) -> Column:
    """Visible text of an HTML fragment: pieces joined by one space, trimmed."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?is)<script\b.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<[a-zA-Z/!?][^>]*>", " ")
    return F.trim(F.regexp_replace(decode_entities(text), r"[\s\u00A0]+", " "))


def base_url(url: Column) -> Column:
    """``scheme://host`` of a URL, or the text itself when it is none."""
    host = F.regexp_extract(url, r"^(https?://[^/]+)", 1)
    return F.when(host != "", host).otherwise(url)


def first_host_label(url: Column) -> Column:
    return F.substring_index(F.regexp_replace(url, r"https?://", ""), ".", 1)


def full_host(url: Column) -> Column:
    return F.substring_index(F.rtrim(F.regexp_replace(url, r"https?://", "")), "/", 1)


def next_page_url(url: Column, page: Column) -> Column:
    """URL of listing page ``page``; page 1 is the URL itself."""
    mark = F.when(F.contains(url, F.lit("?")), F.lit("&page=")).otherwise(F.lit("?page="))
    return F.when(page == 1, url).otherwise(F.concat(url, mark, page.cast("string")))


def blank_to_null(value: Column) -> Column:
    return F.when(value != "", value)


def option_values(options: Column, field: str, keywords: list[str]) -> Column:
    """Values of the first option whose name holds one of the keywords, joined by ", "."""
    pattern = "|".join(keywords)
    hits = F.filter(options, lambda o: F.lower(F.coalesce(o["name"], F.lit(""))).rlike(pattern))
    return F.coalesce(F.array_join(F.get(hits, F.lit(0))[field], ", "), F.lit(""))


def try_epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def finite(value: Column) -> Column:
    """NaN and infinities as null, so that aggregates skip them."""
    v = value.try_cast("double")
    bad = F.isnan(v) | (F.abs(v) == F.lit(float("inf")))
    return F.when(~bad, v)

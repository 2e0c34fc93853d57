"""Column expressions that read the fields of a feed item. Whitespace is Unicode whitespace."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperlake import constants as K

# Whitespace as Unicode defines it, with the four separator controls.
_SPACES = r"(?U)[\s\x1C-\x1F]+"

# RFC 822: optional weekday, day, month name, year of four or two digits, and a valid time of day.
_DAY_MONTH_YEAR = (
    r"^(?:[A-Za-z]+,?\s+)?(\d{1,2}\s+[A-Za-z]{3,9}\s+(?:\d{4}|\d{2}))\s+"
    r"(?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d)?(?:\s|$)"
)


def strip(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def feed_paper_id(guid: Column, link: Column) -> Column:
    """Identifier from the guid, else from the link, without its version; else empty."""
    found = F.coalesce(
        empty_to_null(F.regexp_extract(strip(guid), "(?U)" + K.GUID_ID, 1)),
        F.regexp_extract(strip(link), "(?U)" + K.LINK_ID, 1),
    )
    return F.regexp_replace(found, K.ID_VERSION, "")


def feed_abstract(description: Column) -> Column:
    body = F.regexp_replace(F.coalesce(description, F.lit("")), "(?sU)" + K.ABSTRACT_HEADER, "")
    plain = F.regexp_replace(body, K.MARKUP_TAG, "")
    return strip(F.regexp_replace(plain, _SPACES, " "))


def feed_authors(creator: Column) -> Column:
    return empty_to_null(strip(creator))


def feed_categories(categories: Column) -> Column:
    kept = F.filter(F.transform(categories, strip), lambda c: c != "")
    return empty_to_null(F.substring(F.array_join(kept, ", "), 1, K.MAX_CATEGORIES_CHARS))


def feed_date(pub_date: Column) -> Column:
    """The calendar day written in an RFC 822 date, in the offset it is written in.

    Two-digit years from 69 on belong to the last century.
    """
    day = F.regexp_extract(strip(pub_date), _DAY_MONTH_YEAR, 1)
    short = F.regexp_extract(day, r"\s(\d{2})$", 1)
    century = F.when(short == "", "").when(short < "69", "20").otherwise("19")
    day = F.concat(F.regexp_replace(day, r"\d+$", ""), century, F.regexp_extract(day, r"(\d+)$", 1))
    short_month = F.regexp_replace(day, r"\s+([A-Za-z]{3})[A-Za-z]*\s+", " $1 ")
    return F.try_to_date(F.initcap(empty_to_null(short_month)), "d MMM yyyy")

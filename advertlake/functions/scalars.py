"""Column expressions that turn landed text into typed values. All of them run in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character; Java's \s alone would miss the no-break spaces.
WHITESPACE = r"[\t-\r\x1c-\x1f\x85\p{Z}]"
# The same for pure ASCII text, a class the regex engine tests by a bit map.
ASCII_WHITESPACE = r"[\t-\r\x1c-\x20]"
# A plain decimal number. Spark's own cast also takes a type suffix as in '12d'.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"

# Currency of a market whose adverts carry none.
CURRENCY_BY_COUNTRY = {
    "gb": "GBP",
    "au": "AUD",
    "at": "EUR",
    "be": "EUR",
    "br": "BRL",
    "ca": "CAD",
    "ch": "CHF",
    "de": "EUR",
    "es": "EUR",
    "fr": "EUR",
    "id": "IDR",
    "in": "INR",
    "it": "EUR",
    "lu": "EUR",
    "mx": "MXN",
    "nl": "EUR",
    "nz": "NZD",
    "pl": "PLN",
    "sg": "SGD",
    "za": "ZAR",
}
DEFAULT_CURRENCY = "GBP"
MONEY_SYMBOLS = ",£€"


def is_ascii(text: Column) -> Column:
    """As many bytes as characters: decided from lengths, without looking at the text."""
    return F.octet_length(text) == F.length(text)


def to_squeeze(spaces: str) -> str:
    """Runs of a character class that are not a single blank already: most blanks need no rewriting."""
    return f"{spaces}(?:(?<! )|{spaces}){spaces}*+"


def collapse_whitespace(text: Column) -> Column:
    narrow = F.regexp_replace(text, to_squeeze(ASCII_WHITESPACE), " ")
    wide = F.regexp_replace(text, to_squeeze(WHITESPACE), " ")
    return F.btrim(F.when(is_ascii(text), narrow).otherwise(wide))


def clean_string(text: Column) -> Column:
    """White space collapsed and stripped; nothing left becomes null."""
    return F.nullif(collapse_whitespace(text), F.lit(""))


def to_number(text: Column, symbols: str = "") -> Column:
    """Text to double with ``symbols`` removed; anything but a plain number becomes null."""
    bare = F.translate(text, symbols, "") if symbols else text
    bare = F.regexp_replace(bare, f"^{WHITESPACE}+|{WHITESPACE}+$", "")
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def money(text: Column, symbols: str = MONEY_SYMBOLS) -> Column:
    return to_number(text, symbols)


def balanced_pair(low: Column, high: Column) -> tuple[Column, Column]:
    """Order a pair and fill a missing half; ``least`` and ``greatest`` skip nulls."""
    return F.least(low, high), F.greatest(low, high)


def contract_label(text: Column) -> Column:
    return F.translate(F.lower(clean_string(text)), " ", "_")


def parse_utc(text: Column, formats: Sequence[str] = ()) -> Column:
    """ISO text (or one of ``formats``) to timestamp; unparsable becomes null.

    The year is required because a bare time of day would be read as today.
    """
    dated = F.when(text.rlike(r"^\s*[0-9]{4}"), text)
    iso = F.try_to_timestamp(dated)
    listed = [F.try_to_timestamp(text, F.lit(pattern)) for pattern in formats]
    return F.coalesce(iso, *listed) if listed else iso


def utc_date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def truthy_number(text: Column) -> Column:
    """True for a number whose integer part is not zero, or for the word true; garbage is false."""
    word = F.when(F.lower(F.btrim(text)) == "true", F.lit(1.0)).otherwise(F.lit(0.0))
    value = F.coalesce(to_number(text), word)
    return F.abs(value) >= 1.0


def currency_or_default(
    own: Column,
    country: Column,
    by_country: Mapping[str, str] = CURRENCY_BY_COUNTRY,
    default: str = DEFAULT_CURRENCY,
) -> Column:
    fallback = F.lit(default)
    if by_country:
        lookup = F.create_map(*[F.lit(x) for pair in by_country.items() for x in pair])
        fallback = F.coalesce(F.try_element_at(lookup, country), fallback)
    return F.coalesce(clean_string(own), fallback)


def period_start(ts: Column, period: str = "week") -> Column:
    """First day of the period as a date; weeks start on Monday."""
    return F.date_trunc(period, ts).cast("date")


def week_label(week: Column) -> Column:
    """``Monday/Sunday`` of a week given by its Monday."""
    return F.concat_ws("/", week.cast("string"), F.date_add(week, 6).cast("string"))


def cell_text(value: Column, dtype: str) -> Column:
    """One spreadsheet cell: null as empty text, whole floats as integers, others as written."""
    if dtype in ("double", "float"):
        return F.coalesce(_float_text(F.when(~F.isnan(value), value)), F.lit(""))
    if dtype == "boolean":
        return F.coalesce(F.initcap(value.cast("string")), F.lit(""))
    if dtype.startswith(("array", "map", "struct")):
        return F.coalesce(F.to_json(value), F.lit(""))
    return F.coalesce(value.cast("string"), F.lit(""))


def _float_text(value: Column) -> Column:
    # Spark writes 12345678.5 as 1.23456785E7. Between 1e-4 and 1e16 the digits are laid out plainly.
    written = value.cast("string")
    plain = F.regexp_replace(written.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    magnitude = F.abs(value)
    infinite = magnitude == float("inf")
    scientific = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(written, r"\.0E", "E"), r"E(-?)(\d)$", "E$10$2"), "E", "e"
    )
    return (
        F.when(infinite, F.when(value > 0, "inf").otherwise("-inf"))
        .when(value == F.floor(value), F.coalesce(value.try_cast("decimal(38,0)").cast("string"), written))
        .when((magnitude >= 1e-4) & (magnitude < 1e16), plain)
        .otherwise(scientific)
    )


def bit_is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a bitmap, as ``bitmap_construct_agg`` makes it, has the bit at a ``bitmap_bit_position``; not if it is null."""
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")) % 2 == 1, F.lit(False))

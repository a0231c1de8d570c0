"""Column functions for raw filing text. Everything stays in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace characters a strip removes, the filing timestamp pattern,
# and the tokens that are a suffix rather than a middle name.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
FILING_TIMESTAMP = "M/d/yyyy h:mm:ss a"
SUFFIX_TOKENS = ("JR.", "SR.")


def strip(c: Column) -> Column:
    """Remove whitespace of any kind from both ends (`trim` alone removes spaces only)."""
    return F.trim(c, F.lit(WHITESPACE))


def clean(c: Column, upper: bool = True) -> Column:
    """Strip, and upper-case unless told otherwise."""
    return F.upper(strip(c)) if upper else strip(c)


def name_key(c: Column) -> Column:
    """The form in which names are compared: stripped and upper-cased."""
    return clean(c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def or_default(c: Column, default: str = "N/A") -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def parse_filing_ts(c: Column) -> Column:
    """Filing timestamp text to a zone-free timestamp; null when it does not parse."""
    return F.try_to_timestamp(strip(c), F.lit(FILING_TIMESTAMP)).cast("timestamp_ntz")


def parse_filing_date(c: Column) -> Column:
    return parse_filing_ts(c).cast("date")


def session_year(ts: Column) -> Column:
    """First year of the two-year legislative session; sessions start in odd years.

    Clearing the last bit of year - 1 rounds down to a session; `ts` is evaluated only once.
    """
    return (F.year(ts) - 1).bitwiseAND(F.lit(-2)) + 1


def amendment_no(c: Column) -> Column:
    """Numeric amendment order from text; a leading number counts, anything else is null.

    Text that is a number from its first character on, as nearly all is, needs no pattern.
    """
    given = c.cast("string")
    whole = given.try_cast("bigint")
    leading = F.regexp_extract(given, r"^\s*([0-9]+)", 1).try_cast("bigint")
    return F.when(whole.isNotNull() & given.substr(1, 1).between("0", "9"), whole).otherwise(leading)


def first_token(c: Column) -> Column:
    return F.split(strip(c), r"\s+").getItem(0)


def city_part(city: Column) -> Column:
    """City of a place field that may hold "CITY, ST"."""
    parts = F.split(city, ", ")
    return F.when(F.size(parts) == 2, parts.getItem(0)).otherwise(city)


def state_part(city: Column, state: Column) -> Column:
    """State, taken from the city field when that holds exactly "CITY, ST"."""
    parts = F.split(city, ", ")
    return F.when(F.size(parts) == 2, parts.getItem(1)).otherwise(state)


def split_city_state(city: Column, state: Column) -> dict[str, Column]:
    return {"city": city_part(city), "state": state_part(city, state)}


def middle_initial(c: Column) -> Column:
    """Middle name as used for prefix matching: trailing dots removed."""
    return F.rtrim(blank_to_null(c), F.lit("."))


def concat_names(*cols: Column) -> Column:
    """Concatenate without a separator; null when any part is null."""
    return F.concat(*cols)


def _tokens(c: Column) -> Column:
    return F.split(c, r"\s+")


def _trailing(c: Column) -> Column:
    """The last token of a stripped name, empty for a single one."""
    return F.when(F.size(_tokens(c)) > 1, F.element_at(_tokens(c), -1)).otherwise("")


def _leading(c: Column) -> Column:
    """What stands before the last token of a stripped name, empty for a single one."""
    before = F.substring(c, F.lit(1), F.length(c) - F.length(_trailing(c)))
    return F.when(F.size(_tokens(c)) > 1, strip(before)).otherwise("")


def split_name(
    first: Column, middle: Column, last: Column, suffix: Column, mode: str = "always"
) -> dict[str, Column]:
    """Cleaned first, middle, last and suffix.

    A missing first name becomes the first token of the last name. Then, in mode "always",
    the trailing token of the first name is its middle name. In mode "dotted" a trailing token
    is split off only when the field ends in a dot and no middle name was given: the last name
    is tried before the first, and a split-off JR. or SR. becomes the suffix.
    """
    last_c = blank_to_null(clean(last))
    first_c = F.coalesce(blank_to_null(clean(first)), first_token(last_c))
    suffix_c = blank_to_null(suffix)
    if mode == "always":
        splits = _leading(first_c) != ""
        return {
            "first": F.when(splits, _leading(first_c)).otherwise(first_c),
            "middle": F.when(splits, _trailing(first_c)),
            "last": last_c,
            "suffix": suffix_c,
        }
    if mode != "dotted":
        raise ValueError(f"unknown mode: {mode}")
    middle_c = blank_to_null(clean(middle))
    from_last = F.coalesce(middle_c.isNull() & last_c.endswith(".") & (_leading(last_c) != ""), F.lit(False))
    from_first = F.coalesce(
        middle_c.isNull() & ~from_last & first_c.endswith(".") & (_leading(first_c) != ""), F.lit(False)
    )
    token = F.when(from_last, _trailing(last_c)).when(from_first, _trailing(first_c))
    is_suffix = F.coalesce(token.isin(*SUFFIX_TOKENS), F.lit(False))
    return {
        "first": F.when(from_first, _leading(first_c)).otherwise(first_c),
        "middle": F.when(~is_suffix, F.coalesce(middle_c, token)),
        "last": F.when(from_last, _leading(last_c)).otherwise(last_c),
        "suffix": F.when(is_suffix, token).otherwise(suffix_c),
    }

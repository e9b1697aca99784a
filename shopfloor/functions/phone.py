"""Phone number rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operator prefix of a phone number -> its current prefix.
PREFIXES = {
    "032": "032", "033": "033", "034": "034", "035": "035", "036": "036", "037": "037",
    "038": "038", "039": "039", "056": "056", "058": "058", "059": "059", "070": "070",
    "076": "076", "077": "077", "078": "078", "079": "079", "081": "081", "082": "082",
    "083": "083", "084": "084", "085": "085", "086": "086", "088": "088", "089": "089",
    "090": "090", "091": "091", "092": "092", "093": "093", "094": "094", "096": "096",
    "097": "097", "098": "098", "099": "099",
    "0120": "070", "0121": "079", "0122": "077", "0123": "083", "0124": "084", "0125": "085",
    "0126": "076", "0127": "081", "0128": "078", "0129": "082",
    "0162": "032", "0163": "033", "0164": "034", "0165": "035", "0166": "036", "0167": "037",
    "0168": "038", "0169": "039", "0199": "059",
}


def digits_only(text: Column) -> Column:
    """Keep the ASCII digits."""
    return F.regexp_replace(text, "[^0-9]", "")


def normalize_phone(text: Column) -> Column:
    """Local form with a leading 0, or null where the digit count fits no number.

    Country code 84 is recognised for 11 and 12 digits. Results have 10 to 12
    digits; old 11-digit prefixes are left alone (see ``rewrite_prefix``).
    """
    number = digits_only(text)
    size = F.length(number)
    with_zero = F.concat(F.lit("0"), number)
    without_country = F.concat(F.lit("0"), F.substring(number, 3, 12))
    local, country = number.startswith("0"), number.startswith("84")
    return (
        F.when(size == 9, with_zero)
        .when(size.isin(10, 11) & local, number)
        .when(size.isin(11, 12) & country, without_country)
        .when(size.isin(10, 11), with_zero)
    )


def _prefix_map() -> Column:
    return F.create_map(*[F.lit(part) for pair in PREFIXES.items() for part in pair])


def _current_prefix(number: Column, width: int) -> Column:
    return F.try_element_at(_prefix_map(), F.left(number, F.lit(width)))


def known_prefix(number: Column) -> Column:
    """The number itself if it starts with a known prefix, else null."""
    known = F.coalesce(_current_prefix(number, 4), _current_prefix(number, 3))
    return F.when(known.isNotNull(), number)


def rewrite_prefix(number: Column) -> Column:
    """Replace an old prefix by its current one; null for an unknown prefix."""
    four, three = _current_prefix(number, 4), _current_prefix(number, 3)
    return F.when(four.isNotNull(), F.concat(four, F.substr(number, F.lit(5)))).when(
        three.isNotNull(), F.concat(three, F.substr(number, F.lit(4)))
    )

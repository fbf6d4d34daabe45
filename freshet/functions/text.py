"""Text and number columns: codes, names, ids, lenient numbers, truncation, boxes, JSON fields."""

from __future__ import annotations

import re
from functools import cache
from unicodedata import normalize

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _plain_letters() -> tuple[str, str, dict[str, str]]:
    """(characters, the one ASCII character that compatibility decomposition leaves of each; those that leave more of them)."""
    one, many = {}, {}
    for n in (*range(0x80, 0x3000), *range(0xF900, 0xFFF0)):
        kept = normalize("NFKD", chr(n)).encode("ascii", "ignore").decode()
        if kept:
            (one if len(kept) == 1 else many)[chr(n)] = kept
    return "".join(one), "".join(one.values()), many


def station_code(code: Column, strip_zeros: bool = True) -> Column:
    """Trimmed upper case, without leading zeros unless that leaves nothing (then ``0``); null where it is blank."""
    c = F.nullif(F.upper(F.trim(code)), F.lit(""))
    return F.when(c.isNotNull(), F.coalesce(F.nullif(F.regexp_replace(c, "^0+", ""), F.lit("")), F.lit("0"))) if strip_zeros else c


def station_name(name: Column) -> Column:
    """Upper case of what is ASCII in the compatibility decomposition (NFKD); marks and what else isn't ASCII are left out."""
    marked, plain, several = _plain_letters()
    letters = F.create_map(*(F.lit(x) for pair in several.items() for x in pair))
    spelled = F.array_join(F.transform(F.split(name, ""), lambda c: F.coalesce(F.element_at(letters, c), c)), "")
    whole = F.when(name.rlike(f"[{re.escape(''.join(several))}]"), spelled).otherwise(name)
    return F.upper(F.regexp_replace(F.translate(F.trim(whole), marked, plain), r"[^\x00-\x7F]", ""))


def station_id(provider: Column, code: Column) -> Column:
    return F.concat_ws(":", provider, code)


def series_id(station: Column, variable: Column, state: Column) -> Column:
    return F.concat_ws(".", station, variable, state)


def nullable_int(text: Column) -> Column:
    """A whole number that may have thousands commas; null where it is blank or none."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^[+-]?\d{1,18}$"), plain.cast("bigint"))


def coordinate(text: Column) -> Column:
    """Degrees cut toward zero to four decimals, in decimal arithmetic; null where it is blank or none."""
    t = F.trim(text)
    exact = F.when(t.rlike(r"^[+-]?\d+(\.\d*)?$"), F.abs(t.cast("decimal(28,18)")))
    return (F.when(t.startswith("-"), -1.0).otherwise(1.0) * F.floor(exact * 10000).cast("double")) / 10000.0


def decimal_comma(text: Column) -> Column:
    """A number with a decimal comma or point; ``-``, blanks and what is none are null."""
    plain = F.regexp_replace(F.trim(text), ",", ".")
    return F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), plain.cast("double"))


def providers(names: Column, ordered: bool = True) -> Column:
    """Lower-cased, trimmed, different names of an array; sorted, or in the order in which they came first."""
    clean = F.array_distinct(F.filter(F.transform(names, lambda x: F.lower(F.trim(x))), lambda x: x.isNotNull() & (x != "")))
    return F.array_sort(clean) if ordered else clean


def asset_id(provider: Column, model: Column, kind: Column, cycle: Column) -> Column:
    return F.concat_ws(".", provider, model, kind, F.date_format(cycle, "yyyyMMddHH"), F.lit("precipitation_grid"))


def step_label(utc: Column, hours: Column) -> Column:
    """A step's hours and its local time."""
    from .timeops import utc_to_local

    return F.concat(F.lit("+"), hours.cast("int").cast("string"), F.lit("h "), F.date_format(utc_to_local(utc), "dd/MM HH:mm"))


def one_decimal(value: Column) -> Column:
    """Cut toward zero to one decimal; what isn't finite stays."""
    cut = F.when(value < 0, F.ceil(value * 10)).otherwise(F.floor(value * 10)) / 10
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(odd, value).otherwise(cut)


def to_centimetres(value: Column, variable: Column) -> Column:
    """Levels in centimetres, everything else as it is."""
    return F.when(variable == "level", value * 100).otherwise(value)


def multiplied(value: Column, factor: Column) -> Column:
    """Value times a positive factor, never below 0; missing stays missing."""
    return F.when(F.isnan(value), value).when(value.isNotNull(), F.greatest(value * factor, F.lit(0.0)))


def buffered_box(west: Column, south: Column, east: Column, north: Column, fraction: float) -> list[Column]:
    """The box widened by a fraction of its width and height on each side, and whether it is still on the globe."""
    dx, dy = (east - west) * fraction, (north - south) * fraction
    box = [west - dx, south - dy, east + dx, north + dy]
    ok = (box[0] >= -180) & (box[2] <= 180) & (box[1] >= -90) & (box[3] <= 90) & (west < east) & (south < north)
    return [c.alias(n) for c, n in zip([*box, ok], ("west", "south", "east", "north", "valid"), strict=True)]


def json_numbers(json: Column, path: str) -> Column:
    """An array of numbers at a path of a JSON text; null where there is none."""
    return F.from_json(F.get_json_object(json, path), "array<double>")


def normal_longitude(lon: Column) -> Column:
    return F.when(lon > 180, lon - 360).otherwise(lon)

"""Fixed-width daily weather records and temperature helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 1-based start and length of each field in a daily summary line,
# and the missing-temperature marker after conversion to Celsius.
FIELDS = {
    "station": (1, 6),
    "year": (15, 4),
    "month": (19, 2),
    "day": (21, 2),
    "max_f": (103, 6),
    "min_f": (111, 6),
}
NO_TEMPERATURE_C = 5537.72   # 9999.9 F in C
KEY_FORMAT = "%d:%02d.%02d"  # station:dd.MM
VALUE_FORMAT = "%.1fC (%d)"  # temperature and year
LINE_WIDTH = 138


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def layout(station_width: int) -> dict[str, tuple[int, int]]:
    """The field table with a station field of another width; later fields move along."""
    by = station_width - FIELDS["station"][1]
    return {n: (start + (by if start > 1 else 0), station_width if n == "station" else width)
            for n, (start, width) in FIELDS.items()}


def field(line, name: str, fields: dict = FIELDS) -> Column:
    start, length = fields[name]
    return F.trim(F.substring(_col(line), start, length))


def parse_gsod(line, fields: dict = FIELDS) -> list[Column]:
    """S12 + F15: station, year, month, day as INT (a wide station as BIGINT); max/min as Celsius FLOAT
    (NULL when unparsable, D18)."""
    wide = fields["station"][1] > 9
    ints = [field(line, n, fields).try_cast("bigint" if wide and n == "station" else "int").alias(n)
            for n in ("station", "year", "month", "day")]
    temps = [to_celsius(field(line, n, fields).try_cast("float")).alias(n.replace("_f", "_c"))
             for n in ("max_f", "min_f")]
    return ints + temps


def to_celsius(f) -> Column:
    """F16: ``(f - 32) * 5 / 9`` in single precision."""
    f = f if isinstance(f, Column) else F.col(f)
    return ((f.cast("float") - F.lit(32).cast("float")) * F.lit(5).cast("float") / F.lit(9)).cast("float")


def has_temp(c) -> Column:
    """A reading is present unless it is within 1 degree of the missing marker."""
    return F.abs(_col(c) - F.lit(NO_TEMPERATURE_C).cast("float")) > 1


def station_day_key(station, day, month) -> Column:
    """``station:dd.MM``."""
    return F.format_string(KEY_FORMAT, _col(station), _col(day), _col(month))


def temp_value(temp, year) -> Column:
    """``%.1fC (year)``."""
    return F.format_string(VALUE_FORMAT, _col(temp), _col(year))


def day_month(date_col) -> Column:
    """``dd.MM`` of a date."""
    return F.date_format(_col(date_col), "dd.MM")


def gsod_line(station, year, month, day, max_f, min_f, fields: dict = FIELDS) -> Column:
    """Inverse of :func:`parse_gsod` (used to stage fixed-width files): fields at their offsets.

    A value wider than its field fails the job instead of moving the later fields.
    """
    texts = {"station": (station, "0"), "year": (year, "0"), "month": (month, "0"), "day": (day, "0"),
             "max_f": (_col(max_f).cast("decimal(20,1)"), " "), "min_f": (_col(min_f).cast("decimal(20,1)"), " ")}
    pieces, at = [], 1
    for name, (start, width) in sorted(fields.items(), key=lambda kv: kv[1]):
        value, fill = texts[name]
        text = _col(value).cast("string")
        fits = F.when(F.length(text) > width, F.raise_error(F.concat(F.lit(f"{name} does not fit {width} characters: "), text)))
        pieces += [F.lit(" " * (start - at)), fits.otherwise(F.lpad(text, width, fill))]
        at = start + width
    tail = LINE_WIDTH + fields["station"][1] - FIELDS["station"][1] + 1 - at
    return F.concat(*pieces, F.lit(" " * max(tail, 0)))

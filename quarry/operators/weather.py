"""Hottest year per (station, calendar day) and its station labels.

The reference finds the maximum by a secondary sort of every reading in a
(station, day) group.  Here the argmax is a hash aggregate with a partial stage:
the maximum of one BIGINT that packs the reading and the year gives the largest
temperature and, among equal ones, the smallest year (D5) without sorting or
collecting a group, so a station holding a third of all rows still shuffles one
row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import weather as W
from quarry.operators.joins import skew_safe_join

# The station file's placeholder id, and the label line format.
UNKNOWN_STATION = "999999"
YEARS = 10_000  # years of four digits
BETWEEN_TENTHS = 0.03  # more than single precision loses on a reading of the daily records
LABEL_FORMAT = "%.4f, %.4f, %s (%s)"


def hottest_year(readings: DataFrame, temp_col: str = "max_c", tenths: bool = False) -> DataFrame:
    """Per (station, day, month) the hottest reading and its year.

    Any Celsius values are compared exactly, as (reading, year) pairs, which Spark can only do
    by sorting.  ``tenths=True`` is for readings of the daily records (S12), tenths of a degree
    Fahrenheit: such a reading and its year of four digits fit one integer, and nothing is
    sorted; a reading between tenths or another year fails the job.

    ``readings`` has station, year, month, day and a Celsius ``temp_col``.
    -> (station, day, month, year, max_c, key, value) with key ``station:dd.MM``
    and value ``%.1fC (year)``.
    """
    valid = readings.filter(W.has_temp(temp_col))
    if tenths:
        exact = F.col(temp_col).cast("double") * 18 + 320
        fits = (F.abs(exact - F.round(exact)) < BETWEEN_TENTHS) & F.col("year").between(0, YEARS - 1)
        wrong = F.raise_error(F.concat(F.lit("no whole tenth of a degree Fahrenheit, or no year of four digits: "),
                                       F.col(temp_col).cast("string"), F.lit(" in "), F.col("year").cast("string")))
        packed = F.when(fits, F.round(exact).cast("bigint") * YEARS + (YEARS - 1 - F.col("year"))).otherwise(wrong.cast("bigint"))
        best = valid.groupBy("station", "day", "month").agg(F.max(packed).alias("b"))
        f = (F.floor(F.col("b") / YEARS) / F.lit(10.0)).cast("float")
        best = best.select("station", "day", "month", (YEARS - 1 - F.pmod("b", F.lit(YEARS))).cast("int").alias("year"),
                           W.to_celsius(f).alias("max_c"))
    else:
        best = (valid.groupBy("station", "day", "month")
                .agg(F.min(F.struct((-F.col(temp_col)).alias("neg"), F.col("year"))).alias("b"))
                .select("station", "day", "month", F.col("b.year").alias("year"), (-F.col("b.neg")).alias("max_c")))
    return best.select("*", W.station_day_key("station", "day", "month").alias("key"),
                       W.temp_value("max_c", "year").alias("value"))


def skipped_readings(readings: DataFrame, temp_col: str = "max_c") -> DataFrame:
    """A18 SkippedValues: one row (readings, skipped)."""
    return readings.agg(F.count(F.lit(1)).alias("readings"),
                        F.count_if(~W.has_temp(temp_col)).alias("skipped"))


def usable_stations(stations: DataFrame) -> DataFrame:
    """P7 + J1 dedupe: drop the placeholder id and rows without coordinates; one row per id.

    ``stations`` has usaf STRING, lat/lon STRING, name STRING and optional ``ord`` (file order).
    A duplicate id keeps its last row by ``ord`` (the reference's dict overwrite), else the
    largest row.
    """
    ok = stations.filter((F.col("usaf") != UNKNOWN_STATION) & (F.col("lat") != "") & (F.col("lon") != ""))
    typed = ok.select(F.col("usaf").try_cast("bigint").alias("station"),
                      F.struct(F.col("lat").try_cast("double").alias("lat"),
                               F.col("lon").try_cast("double").alias("lon"),
                               F.col("name")).alias("info"),
                      (F.col("ord") if "ord" in stations.columns else F.lit(0)).alias("ord"))
    one = typed.groupBy("station").agg(F.max_by("info", F.struct("ord", "info")).alias("info"))
    return one.select("station", "info.lat", "info.lon", "info.name")


def station_labels(hottest: DataFrame, stations: DataFrame, **join_opts) -> DataFrame:
    """J1 + K9: label line ``lat, lon, name (value)`` for results whose station is known (``skew_safe_join``)."""
    st = usable_stations(stations)
    j = skew_safe_join(hottest.select("station", "key", "value"), st, "station", "inner", **join_opts)
    return j.select("station", "key",
                    F.format_string(LABEL_FORMAT, "lat", "lon", "name", "value").alias("label"))


def stations_missing(hottest: DataFrame, stations: DataFrame, **join_opts) -> DataFrame:
    """Results whose station has no usable row -> (station, key)."""
    st = usable_stations(stations).select("station")
    return skew_safe_join(hottest.select("station", "key"), st, "station", "left_anti", **join_opts)


def on_this_day(hottest: DataFrame, day: int, month: int) -> DataFrame:
    """P12 (D16): results of one calendar day, given explicitly rather than read from the clock."""
    return hottest.filter((F.col("day") == day) & (F.col("month") == month)).select("key", "value")


def parse_result_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Input side of J1: result lines ``station:dd.MM<TAB>value`` -> (station, key, value).

    F25: the first whitespace field is the key, the other fields joined by one space
    are the value; the station id is the number before ``:``.
    """
    from quarry.functions.text import first_field_rest

    key, rest = first_field_rest(line_col)
    return (lines.select(key.alias("key"), rest.alias("value"))
            .select(F.split("key", ":")[0].try_cast("bigint").alias("station"), "key", "value")
            .filter(F.col("station").isNotNull()))

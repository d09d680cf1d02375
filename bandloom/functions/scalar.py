"""Names, dates, formats and colours as columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def region_key(output_file: Column, l1t_file_names: Column) -> Column:
    """outputFile, else the first *_FILE_NAME of the metadata; 22 characters."""
    return F.substring(F.coalesce(output_file, F.try_element_at(F.array_sort(l1t_file_names), F.lit(1))), 1, 22)


def contour_id(cluster: Column, file: Column) -> Column:
    n = F.length(file)
    return F.concat(F.lit("C"), cluster.cast("string"), F.lit("-"), F.substring(file, n - 24, F.lit(5)), F.lit("-"), F.substring(file, n - 10, F.lit(3)))


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def day_of_year(year: Column, day: Column) -> Column:
    """The date of a day of a year."""
    return F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day.cast("int") - 1)


def padded_day(day: Column) -> Column:
    return F.lpad(day.cast("string"), 3, "0")


def month(date: Column) -> Column:
    return F.date_format(date, "MM")


def start_time(text: Column) -> Column:
    """A "year day-of-year H:m:s" start time; null when it does not parse."""
    return F.try_to_timestamp(text, F.lit("yyyy D H:m:s"))


def score_text(score: Column) -> Column:
    return F.format_string("%.4f", score)


def whole_text(score: Column) -> Column:
    """Digits before the point only."""
    return F.format_string("%d", score.cast("long"))


def color(palette: Sequence[str], counter: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, palette)), F.pmod(counter, F.lit(len(palette))).cast("int") + 1)


def explained_text(ratios: Column) -> Column:
    return F.concat(F.lit("Explained variance: "), F.array_join(F.transform(ratios, lambda r: F.concat(F.round(r * 100, 1).cast("string"), F.lit("%"))), ", "))


def catalog_record(directory: Column, start: Column, radiance: Column, corners: Column) -> Column:
    return F.to_json(F.struct(directory.alias("directory"), F.unix_millis(start).alias("acquisition_start"), radiance.alias("radiance"), corners.alias("corners")))


def _l1t(json: Column, group: str, name: str) -> Column:
    return F.get_json_object(json, f"$.L1T.L1_METADATA_FILE.{group}.{name}")


def acquisition_start(json: Column) -> Column:
    """Milliseconds of the start time in image metadata; null if it is missing or does not parse."""
    return F.unix_millis(start_time(_l1t(json, "PRODUCT_METADATA", "START_TIME")))


def acquisition_end(json: Column) -> Column:
    return F.unix_millis(start_time(_l1t(json, "PRODUCT_METADATA", "END_TIME")))


def sun_azimuth(json: Column) -> Column:
    return _l1t(json, "PRODUCT_PARAMETERS", "SUN_AZIMUTH").try_cast("double")


def sun_elevation(json: Column) -> Column:
    return _l1t(json, "PRODUCT_PARAMETERS", "SUN_ELEVATION").try_cast("double")


def sensor_look_angle(json: Column) -> Column:
    return _l1t(json, "PRODUCT_PARAMETERS", "SENSOR_LOOK_ANGLE").try_cast("double")


def radiance_scaling(json: Column) -> Column:
    """Map from name to factor; empty if there is none."""
    found = F.from_json(F.get_json_object(json, "$.L1T.L1_METADATA_FILE.RADIANCE_SCALING"), "map<string,double>")
    return F.coalesce(found, F.create_map().cast("map<string,double>"))


def libm_exp(value: Column) -> Column:
    """exp as the C library rounds it. Java's differs in the last bit of one value in 18, which a floor can turn into 1."""

    def exp(v: float) -> float:
        try:
            return math.exp(v)
        except OverflowError:
            return math.inf

    @F.arrow_udf("double")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else exp(v) for v in values.to_pylist()], pa.float64())

    return run(value)

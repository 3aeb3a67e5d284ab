"""Interchange codecs: year-first keys, fixed-width counts, packed year records; and readable forms of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_BYTES = 24  # year, matches and volumes, each an unsigned 64-bit little-endian number
LAST_YEAR = 9999


def year_key(year: Column, ngram: Column) -> Column:
    """Four big-endian bytes of the year before the n-gram's UTF-8, so that keys sort by year; null outside 0 to 9999."""
    head = F.unhex(F.lpad(F.hex(year.cast("long")), 8, "0"))
    return F.when(year.between(0, LAST_YEAR), F.concat(head, F.encode(ngram, "UTF-8")))


def key_year(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("int")


def key_ngram(key: Column) -> Column:
    return F.decode(F.substring(key, 5, 1 << 30), "UTF-8")


def _little_endian(value: Column) -> Column:
    digits = F.lpad(F.hex(value.cast("long")), 16, "0")
    return F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)])


def stats_value(matches: Column, volumes: Column) -> Column:
    """Sixteen bytes: matches and volumes, little-endian."""
    return F.unhex(F.concat(_little_endian(matches), _little_endian(volumes)))


def value_number(value: Column, index: int) -> Column:
    """The index-th 64-bit little-endian number of a value."""
    digits = F.hex(F.substring(value, 8 * index + 1, 8))
    return F.conv(F.concat(*[F.substring(digits, 15 - 2 * i, 2) for i in range(8)]), 16, 10).cast("long")


def pack_records(freqs: Column) -> Column:
    """An array of (year, match_count, volume_count) as packed records."""
    return F.unhex(F.array_join(F.transform(freqs, lambda f: F.concat(_little_endian(f["year"]), _little_endian(f["match_count"]), _little_endian(f["volume_count"]))), ""))


_RECORDS = T.ArrayType(T.StructType([T.StructField("year", T.IntegerType()), T.StructField("match_count", T.LongType()), T.StructField("volume_count", T.LongType())]))


def _records(value: bytes | None, strict: bool) -> list | None:
    if value is None or not strict and len(value) % RECORD_BYTES:
        return None
    if len(value) % RECORD_BYTES:
        raise ValueError(f"{len(value)} bytes are no whole number of records")
    return [{"year": int(y), "match_count": int(m), "volume_count": int(v)} for y, m, v in np.frombuffer(value, "<u8").reshape(-1, 3)]


@F.pandas_udf(_RECORDS)
def unpack_records(values: pd.Series) -> pd.Series:
    """Packed records as an array; a length that is no multiple of RECORD_BYTES is an error."""
    return values.map(lambda v: _records(v, True))


@F.pandas_udf(_RECORDS)
def unpack_whole_records(values: pd.Series) -> pd.Series:
    """Packed records as an array; null, so that the n-gram can be skipped, where the length is no multiple of RECORD_BYTES."""
    return values.map(lambda v: _records(v, False))


def parse_key(text: Column) -> tuple[Column, Column]:
    """(year, n-gram) of a readable key `[year] ngram`; without a year, year 0 and the whole text."""
    pattern = r"^\[(\d+)\]\s*(.*)$"
    year = F.regexp_extract(text, pattern, 1)
    return F.when(year == "", F.lit(0)).otherwise(year.try_cast("int")), F.when(year == "", text).otherwise(F.regexp_extract(text, pattern, 2))


def parsed_key(text: Column) -> Column:
    """The key that a readable one stands for: `[year]` alone gives the four bytes that a year's keys begin with."""
    year, ngram = parse_key(text)
    return F.when(year.between(0, LAST_YEAR), F.concat(F.unhex(F.lpad(F.hex(year.cast("long")), 8, "0")), F.encode(ngram, "UTF-8")))


def _text(data: Column) -> Column:
    """UTF-8 as text; other bytes as their first 40 hexadecimal digits."""
    more = F.when(F.octet_length(data) > 20, F.lit("...")).otherwise(F.lit(""))
    return F.coalesce(F.try_validate_utf8(data.cast("string")), F.concat(F.lit("<binary: "), F.substring(F.lower(F.hex(data)), 1, 40), more, F.lit(">")))


def format_key(key: Column, form: str = "auto") -> Column:
    """A key as text. hex; utf-8; pivot: `[year] ngram`; auto: pivot if its head is a year from 1000 to 2100, else utf-8."""
    rest = F.substring(key, 5, 1 << 30)
    pivot = F.when(F.octet_length(key) >= 4, F.concat(F.lit("["), F.conv(F.hex(F.substring(key, 1, 4)), 16, 10), F.lit("] "), _text(rest)))
    forms = {
        "hex": F.lower(F.hex(key)), "utf-8": _text(key),
        "pivot": pivot.otherwise(F.concat(F.lit("<invalid pivot key: "), F.octet_length(key).cast("string"), F.lit(" bytes>"))),
        "auto": F.when((F.octet_length(key) >= 4) & F.conv(F.hex(F.substring(key, 1, 4)), 16, 10).cast("long").between(1000, 2100), pivot).otherwise(_text(key)),
    }
    if form not in forms:
        raise ValueError(f"unknown form {form!r}")
    return forms[form]


def format_value(value: Column, form: str = "auto") -> Column:
    """A value as text. hex; pivot: counts of 16 bytes; packed: the year records; summary: their totals; auto: pivot or summary by length."""
    size, grouped = F.octet_length(value), lambda n: F.format_number(n, 0)
    odd = lambda text, tail="": F.concat(F.lit(text), size.cast("string"), F.lit(f" bytes{tail}>"))
    pivot = F.when(size == 16, F.concat(grouped(value_number(value, 0)), F.lit(" occurrences in "), grouped(value_number(value, 1)), F.lit(" documents")))
    places = F.when(size > 0, F.sequence(F.lit(0), F.floor(size / RECORD_BYTES).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def number(i: Column, k: int) -> Column:
        digits = F.hex(F.substring(value, i * RECORD_BYTES + 8 * k + 1, F.lit(8)))
        return F.conv(F.concat(*[F.substring(digits, 15 - 2 * j, 2) for j in range(8)]), 16, 10).cast("long")

    years = F.transform(places, lambda i: number(i, 0))
    total = lambda k: F.aggregate(F.transform(places, lambda i: number(i, k)), F.lit(0).cast("long"), lambda a, x: a + x)
    said = F.concat(
        F.lit("Total: "), grouped(total(1)), F.lit(" occurrences in "), grouped(total(2)), F.lit(" volumes ("), F.array_min(years).cast("string"), F.lit("-"),
        F.array_max(years).cast("string"), F.lit(", "), F.size(years).cast("string"), F.lit(" years)"),
    )
    summary = F.when(size % RECORD_BYTES != 0, odd("<non-24-byte-aligned: ")).when(size == 0, F.lit("No data")).otherwise(said)
    record = lambda i: F.concat(F.lit("("), number(i, 0).cast("string"), F.lit(", "), number(i, 1).cast("string"), F.lit(", "), number(i, 2).cast("string"), F.lit(")"))
    packed = F.when(size % RECORD_BYTES != 0, odd("<non-24-byte-aligned: ")).otherwise(F.array_join(F.transform(places, record), ", "))
    forms = {
        "hex": F.lower(F.hex(value)), "utf-8": _text(value), "summary": summary, "packed": packed, "pivot": pivot.otherwise(odd("<invalid pivot format: ", ", expected 16")),
        "auto": pivot.when(size % RECORD_BYTES == 0, summary).otherwise(odd("<unknown format: ")),
    }
    if form not in forms:
        raise ValueError(f"unknown form {form!r}")
    return forms[form]


def format_rate(count: Column, seconds: Column, unit: str = "items") -> Column:
    """A rate with as many digits as tell something: none from 1000 on, one from 10 on, else two."""
    rate = count / seconds
    text = F.when(rate >= 1000, F.format_number(rate, 0)).when(rate >= 10, F.format_string("%.1f", F.bround(rate, 1))).otherwise(F.format_string("%.2f", F.bround(rate, 2)))
    return F.concat(F.when(seconds > 0, text).otherwise(F.lit("0")), F.lit(f" {unit}/sec"))


def format_percentage(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit("0.0%")).otherwise(F.format_string("%.1f%%", F.bround(part / whole * 100, 1)))


def format_elapsed(seconds: Column) -> Column:
    """Whole seconds as h:mm:ss."""
    s = seconds.cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def shorten_path(path: Column, width: int) -> Column:
    """A path of at most `width` characters, its end behind three dots where it is longer."""
    return F.when(F.length(path) <= width, path).when(F.lit(width < 4), F.lit("...")).otherwise(F.concat(F.lit("..."), F.right(path, F.lit(width - 3))))


def format_bytes(size: Column, largest: str = "TB") -> Column:
    """Bytes in steps of 1024 with two digits, in units up to the largest; ties go to the even digit, as in printf."""
    units = ("KB", "MB", "GB", "TB")
    out = F.concat(size.cast("long").cast("string"), F.lit(" B"))
    for power, unit in enumerate(units[: units.index(largest) + 1], 1):
        # Java's %.2f rounds the shortest decimal form half up. Fractions here are whole multiples of 2^-40, so their hundredths are exact.
        scaled = size / float(1024**power)
        cents = F.rint((scaled - F.floor(scaled)) * 100).cast("long")
        text = F.format_string(f"%d.%02d {unit}", F.floor(scaled) + F.floor(cents / 100), cents % 100)
        out = F.when(size >= 1024**power, text).otherwise(out)
    return out


def format_count(n: Column) -> Column:
    """Counts in K, M and B with two digits."""
    out = n.cast("long").cast("string")
    for step, unit in ((10**3, "K"), (10**6, "M"), (10**9, "B")):
        out = F.when(n >= step, F.format_string(f"%.2f{unit}", n / float(step))).otherwise(out)
    return out


def summarise(wide: DataFrame) -> DataFrame:
    """ngram -> total matches and volumes, first and last year, number of years, from an array of year records."""
    total = lambda name: F.aggregate("freqs", F.lit(0).cast("long"), lambda a, f: a + f[name])
    return wide.select(
        "ngram", total("match_count").alias("total_matches"), total("volume_count").alias("total_volumes"),
        F.array_min(F.transform("freqs", lambda f: f["year"])).alias("first_year"),
        F.array_max(F.transform("freqs", lambda f: f["year"])).alias("last_year"),
        F.size("freqs").cast("long").alias("n_years"),
    )

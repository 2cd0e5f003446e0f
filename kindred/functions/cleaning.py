"""Cleaning rules for single columns. Text in, text or BIGINT or DOUBLE out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "missing", accepted spellings of flags, e-mail shape.
MISSING_TEXTS = ["", "NONE", "NULL", "N/A", "NA"]
TRUE_TEXTS = ["true", "1", "yes"]
FALSE_TEXTS = ["false", "0", "no"]
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
TEST_EMAIL_DOMAINS = ["@test.com", "@example.com"]
# Separator and order of dates that are not written year first.
DATE_ORDERS = {"-": "d-M-yyyy", "/": "M/d/yyyy"}
STD_FORMAT = "yyyy-MM-dd HH:mm:ss"


def std_string(col: Column) -> Column:
    """Trimmed upper case; the usual placeholders become NULL."""
    text = F.trim(F.upper(col.cast("string")))
    return F.when(~text.isin(MISSING_TEXTS), text)


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit("TRUE")).otherwise(F.lit("FALSE"))


def std_email(name: str, col: Column | None = None) -> list[Column]:
    """Four outputs: cleaned, validated, hash of the raw upper-cased value, flag."""
    raw = F.col(name) if col is None else col
    clean = F.lower(F.trim(raw))
    valid = F.coalesce(clean.rlike(EMAIL_PATTERN), F.lit(False))
    return [
        clean.alias(name),
        F.when(valid, clean).alias(f"{name}_std"),
        F.when(valid, F.sha2(F.upper(raw), 256)).alias(f"{name}_hash"),
        _flag(valid).alias(f"{name}_valid"),
    ]


def phone_digits(raw: Column) -> Column:
    """Ten digits, a leading country 1 dropped; anything else is NULL."""
    digits = F.regexp_replace(F.trim(raw), "[^0-9]", "")
    return F.when(F.length(digits) == 10, digits).when(
        (F.length(digits) == 11) & digits.startswith("1"), F.substring(digits, 2, 10)
    )


def std_phone(name: str, col: Column | None = None) -> list[Column]:
    """Raw value plus validated number, its hash and a flag."""
    raw = F.col(name) if col is None else col
    number = phone_digits(raw)
    return [
        raw.alias(name),
        number.alias(f"{name}_std"),
        F.sha2(number, 256).alias(f"{name}_hash"),
        _flag(number.isNotNull()).alias(f"{name}_valid"),
    ]


def _dated_text(text: Column, separator: str, order: str) -> Column:
    """One day-month or month-day form, alone, with a time, or with a fraction.

    The shape is tested first: a failed parse is far dearer than a pattern test.
    One or two digits are accepted for all parts but the year.
    """
    day = rf"^\d{{1,2}}{separator}\d{{1,2}}{separator}\d{{4}}"
    clock = r" \d{1,2}:\d{1,2}:\d{1,2}"
    return (
        F.when(text.rlike(day + "$"), F.try_to_timestamp(text, F.lit(order)))
        .when(text.rlike(day + clock + "$"), F.try_to_timestamp(text, F.lit(f"{order} H:m:s")))
        .when(text.rlike(day + clock + r"\.\d{1,6}$"), F.try_to_timestamp(text, F.lit(f"{order} H:m:s.SSSSSS")))
    )


def parse_date_text(col: Column) -> Column:
    """First form that fits: ISO-like text, epoch seconds, day-month-year, month/day/year."""
    text = F.trim(col.cast("string"))
    # Dates written year first, with or without T, fraction and offset.
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("timestamp"))
    epoch = F.when(text.rlike(r"^\d{9,11}$"), F.timestamp_seconds(text.try_cast("long")))
    return F.coalesce(iso, epoch, *[_dated_text(text, sep, order) for sep, order in DATE_ORDERS.items()])


def _date_outputs(name: str, original: Column, ts: Column) -> list[Column]:
    std = F.date_format(ts, STD_FORMAT)
    return [
        original.cast("string").alias(name),
        std.alias(f"{name}_std"),
        F.unix_timestamp(F.date_trunc("second", ts)).alias(f"{name}_unixtime"),
        F.substring(std, 1, 10).alias(f"{name}_date"),
    ]


def std_date(name: str, col: Column | None = None) -> list[Column]:
    """Original text, standard text, epoch seconds and date text."""
    raw = F.col(name) if col is None else col
    return _date_outputs(name, raw, parse_date_text(raw))


def std_iso_utc(name: str, col: Column | None = None) -> list[Column]:
    """As ``std_date`` for ISO text in UTC, written with T and Z or +00:00."""
    raw = F.col(name) if col is None else col
    plain = F.regexp_replace(F.regexp_replace(raw, "T", " "), r"\+00:00|Z", "")
    return _date_outputs(name, raw, plain.try_cast("timestamp"))


def std_epoch(name: str, col: Column | None = None) -> list[Column]:
    """The same four outputs for a column that holds epoch seconds; it stays BIGINT."""
    raw = F.col(name) if col is None else col
    std = F.date_format(F.timestamp_seconds(raw), STD_FORMAT)
    return [
        raw.alias(name),
        std.alias(f"{name}_std"),
        raw.cast("long").alias(f"{name}_unixtime"),
        F.substring(std, 1, 10).alias(f"{name}_date"),
    ]


def std_numeric(col: Column, data_type: str = "string") -> Column:
    """Numbers stay; text becomes a double with two decimals, NULL where it is no number."""
    if data_type in ("tinyint", "smallint", "int", "bigint", "float", "double"):
        return col
    return F.round(F.trim(col).try_cast("double"), 2)


def std_boolean(col: Column) -> Column:
    """'TRUE', 'FALSE' or NULL."""
    text = F.lower(F.trim(col.cast("string")))
    return F.when(text.isin(TRUE_TEXTS), F.lit("TRUE")).when(text.isin(FALSE_TEXTS), F.lit("FALSE"))


def mask_email(email: Column, consent: Column) -> Column:
    """Without consent: three leading characters and the domain; NULL where there is none."""
    domain = F.try_element_at(F.split(email, "@"), F.lit(2))
    masked = F.concat(F.substring(email, 1, 3), F.lit("***@"), domain)
    return F.when(consent, email).otherwise(masked)


def mask_phone(phone: Column, consent: Column) -> Column:
    """Without consent: the last four digits."""
    return F.when(consent, phone).otherwise(F.concat(F.lit("***-***-"), F.substring(phone, -4, 4)))


def mask_text(text: Column, consent: Column) -> Column:
    """Without consent: nothing."""
    return F.when(consent, text)


def email_is_valid(email: Column) -> Column:
    return F.coalesce(email.rlike(EMAIL_PATTERN), F.lit(False))


def email_is_test(email: Column) -> Column:
    hits = F.lit(False)
    for domain in TEST_EMAIL_DOMAINS:
        hits = hits | email.endswith(domain)
    return F.coalesce(hits, F.lit(False))


def check_range(name: str, low: float, high: float, col: Column | None = None) -> list[Column]:
    """Value or NULL when out of range, and a review status."""
    value = F.col(name) if col is None else col
    outside = (value < low) | (value > high)
    return [
        F.when(outside, F.lit(None)).otherwise(value).alias(f"{name}_validated"),
        F.when(outside, F.lit("needs_review")).otherwise(F.lit("valid")).alias("validation_status"),
    ]


def check_date_range(name: str, earliest: str, as_of: int, col: Column | None = None) -> list[Column]:
    """Date or NULL when too old or after ``as_of``, and the date as standard text."""
    value = (F.col(name) if col is None else col).cast("date")
    today = F.timestamp_seconds(F.lit(as_of)).cast("date")
    outside = (value < F.lit(earliest).cast("date")) | (value > today)
    return [
        F.when(outside, F.lit(None)).otherwise(F.date_format(value, "yyyy-MM-dd")).alias(f"{name}_validated"),
        F.date_format(value.cast("timestamp"), STD_FORMAT).alias(f"{name}_timestamp"),
    ]

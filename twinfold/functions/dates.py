"""Partial dates, kept as ISO prefixes: parsing, confidence, order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIRST_YEAR, LAST_YEAR = 1990, 2030
#: A camera's default date that says nothing.
BAD_DEFAULT = ("2012-12-31", "23:00:00")
#: Month names in the order in which they are tried.
MONTHS = [(name, k + 1) for k, name in enumerate("january february march april may june july august september october november december".split())]
MONTHS += [(name[:3], k) for name, k in MONTHS if name != "may"]

#: The published patterns of dates in file names, in the order in which they are tried.
_TIMED = (r"(\d{4})(\d{2})(\d{2})[_-](\d{2})(\d{2})(\d{2})", r"(\d{4})-(\d{2})-(\d{2})[_ ](?:at )?(\d{2})\.(\d{2})\.(\d{2})", r"(\d{4})-(\d{2})-(\d{2})[_-](\d{2})(\d{2})(\d{2})")
_PLAIN = (r"(\d{4})(\d{2})(\d{2})(?!\d)", r"(\d{4})-(\d{2})-(\d{2})(?!\d)")


def _in_range(year: Column) -> Column:
    return year.between(FIRST_YEAR, LAST_YEAR)


def exif_datetime(value: Column) -> Column:
    """'Y:M:D h:m:s' as ISO; null where it isn't a time."""
    at = F.try_to_timestamp(value, F.lit("yyyy:MM:dd HH:mm:ss"))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")


def date_from_filename(name: Column) -> Column:
    """The ISO date or time in a file name, by the first pattern whose leftmost match is a valid one."""
    tries = []
    for pattern in _TIMED:
        y, mo, d, h, mi, s = (F.regexp_extract(name, pattern, k) for k in range(1, 7))
        iso = F.concat(y, F.lit("-"), mo, F.lit("-"), d, F.lit("T"), h, F.lit(":"), mi, F.lit(":"), s)
        real = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd'T'HH:mm:ss")).isNotNull()
        tries.append(F.when((y != "") & y.between(str(FIRST_YEAR), str(LAST_YEAR)) & real, iso))
    for pattern in _PLAIN:
        y, mo, d = (F.regexp_extract(name, pattern, k) for k in range(1, 4))
        iso = F.concat(y, F.lit("-"), mo, F.lit("-"), d)
        real = F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).isNotNull()
        tries.append(F.when((y != "") & y.between(str(FIRST_YEAR), str(LAST_YEAR)) & real, iso))
    return F.coalesce(*tries)


def _month_and_year(path: Column) -> Column:
    """The first month, in the order of MONTHS, that stands beside a year in range: as year-month.

    Of each month the first place counts, in each of three forms: before a year, after one, before two digits.
    """
    names = F.array(*[F.lit(name) for name, _ in MONTHS])
    numbers = F.array(*[F.lit(f"-{k:02d}") for _, k in MONTHS])
    any_month = "(" + "|".join(name for name, _ in MONTHS) + ")"
    limits = (str(FIRST_YEAR), str(LAST_YEAR))

    def places(form: int, pattern: str, month: int, year: int) -> Column:
        taken = F.transform(F.regexp_extract_all(path, F.lit(pattern), F.lit(month)), F.lower)
        item = lambda name, digits: F.struct(F.array_position(names, name).alias("rank"), F.lit(form).alias("form"), name.alias("name"), digits.alias("digits"))
        return F.zip_with(taken, F.regexp_extract_all(path, F.lit(pattern), F.lit(year)), item)

    found = F.concat(places(1, rf"(?i)\b{any_month}\s+(\d{{4}})\b", 1, 2), places(2, rf"(?i)\b(\d{{4}})\s+{any_month}\b", 2, 1), places(3, rf"(?i)\b{any_month}\s+(\d{{2}})\b", 1, 2))
    year = lambda x: F.when(F.length(x["digits"]) == 4, x["digits"]).otherwise(F.concat(F.when(x["digits"] <= "30", F.lit("20")).otherwise(F.lit("19")), x["digits"]))
    first = F.filter(found, lambda x, k: F.size(F.filter(F.slice(found, F.lit(1), k), lambda y: (y["form"] == x["form"]) & (y["name"] == x["name"]))) == 0)
    dated = F.filter(F.transform(first, lambda x: F.struct(x["rank"].alias("rank"), x["form"].alias("form"), year(x).alias("year"))), lambda x: x["year"].between(*limits))
    best = F.array_min(dated)
    return F.concat(best["year"], F.get(numbers, (best["rank"] - 1).cast("int")))


def date_from_path(path: Column) -> Column:
    """The partial date in folder names; null in photo libraries and where there is none."""
    limits = (str(FIRST_YEAR), str(LAST_YEAR))
    folder = r"/(\d{2})(\d{2})(\d{2})\s+[^/]+/"
    yy, mm, dd = (F.regexp_extract(path, folder, k) for k in (1, 2, 3))
    iso = F.concat(F.when(yy <= "30", F.lit("20")).otherwise(F.lit("19")), yy, F.lit("-"), mm, F.lit("-"), dd)
    day = F.when((yy != "") & F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).isNotNull(), iso)
    feast = F.regexp_extract(path, r"(?i)\b(xmas|christmas)\s+(\d{4})\b", 2)
    year = F.regexp_extract(path, r"/(\d{4})/", 1)
    tries = (day, _month_and_year(path), F.when(feast.between(*limits), F.concat(feast, F.lit("-12"))), F.when(year.between(*limits), year))
    return F.when(~(path.contains(".photolibrary") | path.contains(".photoslibrary")), F.coalesce(*tries))


def path_confidence(value: Column) -> Column:
    """A bare year says least."""
    return F.when(F.length(value) == 4, "low").when(value.isNotNull(), "medium")


def exif_confidence(value: Column, make: Column, model: Column, software: Column) -> Column:
    """high, medium, low, suspect or unusable, for an ISO time and who wrote it."""
    filled = lambda c: F.coalesce(c, F.lit("")) != ""
    at = F.coalesce(F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss")), F.try_to_timestamp(value, F.lit("yyyy-MM-dd")))
    return (
        F.when(~filled(value), "unusable")
        .when(value.startswith(BAD_DEFAULT[0]) & value.contains(BAD_DEFAULT[1]), "unusable")
        .when(at.isNull() | ~_in_range(F.year(at)), "suspect")
        .when(filled(make) | filled(model), "high")
        .when(filled(software), "low")
        .otherwise("medium")
    )


def year_of(value: Column) -> Column:
    digits = F.substring(value, 1, 4)
    return F.when(digits.rlike("^[0-9]{4}$"), digits).try_cast("int")


def date_sort_key(value: Column) -> Column:
    """Partial dates in order: missing parts count as 00, no date is last."""
    parts = F.split(value, r"[-T:]")
    padded = F.concat(parts, F.array_repeat(F.lit("00"), 6))
    full = F.concat(F.array_join(F.slice(padded, 1, 3), "-"), F.lit("T"), F.array_join(F.slice(padded, 4, 3), ":"))
    return F.when(F.coalesce(value, F.lit("")) == "", "9999-99-99T99:99:99").otherwise(full)


def display_date(value: Column) -> Column:
    return F.coalesce(F.substring(value, 1, 10), F.lit("unknown"))

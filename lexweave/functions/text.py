"""Small text and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bare_selector(selector: Column) -> Column:
    """Field name of a metadata selector: ``custom.amount`` is ``amount``."""
    return F.replace(selector, F.lit("custom."), F.lit(""))


def parts(text: Column, delimiter: str = "\\|") -> Column:
    """Parts of a delimited text as an array, blank ones too; null of null."""
    return F.split(text, delimiter)


def tokens(text: Column, delimiter: str = "\\|") -> Column:
    """Parts of a delimited text as an array; blank parts carry no meaning and go."""
    return F.array_remove(parts(text, delimiter), "")


def tenant_of_url(url: Column) -> Column:
    """``https://acme.host.com/x`` belongs to tenant ``acme``."""
    return F.regexp_extract(url, r"//([^.]+)", 1)


def uri_parts(uri: Column) -> tuple[Column, Column]:
    """Bucket and key of a storage address; scheme and key may be absent."""
    pattern = r"^(?:[a-z0-9]+://)?([^/]*)/?(.*)$"
    return F.regexp_extract(uri, pattern, 1), F.regexp_extract(uri, pattern, 2)


def event_time(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def utc_day(millis: Column) -> Column:
    """The event's day in UTC, in any session zone."""
    return F.date_from_unix_date(F.floor(millis / 86_400_000).cast("int"))

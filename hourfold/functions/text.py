"""Text keys and alert text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def account_key(account: Column, trim_trailing: bool = False) -> Column:
    key = F.lower(account)
    return F.rtrim(key) if trim_trailing else key


def status_is(status: Column, *values: str) -> Column:
    """Status comparison that ignores case, as the stored tables mix both."""
    return F.lower(status).isin([v.lower() for v in values])


def message(template: str, *parts: Column) -> Column:
    return F.format_string(template, *[p.cast("string") for p in parts])

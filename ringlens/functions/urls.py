"""URL parts; a text that is no URL gives NULL instead of an error."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ringlens.functions.numbers import col


def url_part(url: str | Column, part: str) -> Column:
    return F.try_parse_url(col(url), F.lit(part))


def query_value(url: str | Column, key: str) -> Column:
    return F.try_parse_url(col(url), F.lit("QUERY"), F.lit(key))


# fixed values: advertising marks read from a landing page address
UTM_TAGS = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term")
CLICK_IDS = ("gclid", "yclid", "ymclid")
OPENSTAT_PARTS = ("openstat_service", "openstat_campaign", "openstat_ad", "openstat_source")


def url_tags(url: str | Column, referrer: str | Column | None = None) -> dict[str, Column]:
    """Advertising tags of a landing address and the domain of its referrer.

    ``_openstat`` packs four values separated by ';'.
    """
    out = {t: query_value(url, t) for t in (*UTM_TAGS, *CLICK_IDS)}
    parts = F.split(query_value(url, "_openstat"), ";")
    for i, name in enumerate(OPENSTAT_PARTS):
        out[name] = F.get(parts, F.lit(i))
    if referrer is not None:
        out["referrer_domain"] = url_part(referrer, "HOST")
    return out

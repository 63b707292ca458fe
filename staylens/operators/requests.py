"""Search requests: one row per destination."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.rules import DATE_FORMAT, SEARCH_PARAMETERS

DEFAULT_BASE_URL = "https://listings.example/searchresults.html?"


def search_requests(
    destinations: DataFrame,
    run_date: dt.date | str,
    base_url: str = DEFAULT_BASE_URL,
    encode: bool = False,
) -> DataFrame:
    """``destinations(dest_seq, city)`` -> request URL for a one-night stay.

    The run date is an argument, so that a re-run gives the same requests.  The
    city goes into the URL as it is unless ``encode`` is set.
    """
    checkin = F.lit(str(run_date)).cast("date")
    checkout = F.date_add(checkin, 1)
    city = F.url_encode("city") if encode else F.col("city")
    fixed = "".join(f"&{name}={value}" for name, value in SEARCH_PARAMETERS)
    url = F.concat(
        F.lit(base_url + "ss="),
        city,
        F.lit("&checkin="),
        F.date_format(checkin, DATE_FORMAT),
        F.lit("&checkout="),
        F.date_format(checkout, DATE_FORMAT),
        F.lit(fixed),
    )
    return destinations.select(
        "dest_seq",
        "city",
        checkin.alias("checkin"),
        checkout.alias("checkout"),
        url.alias("url"),
    )

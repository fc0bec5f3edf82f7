"""The daily ad tables from a finished log, without a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from clickloom.operators import ads
from clickloom.session import stored


@dataclass(frozen=True)
class DailyAds:
    user_counts: DataFrame
    blacklist: DataFrame
    city_counts: DataFrame
    province_top: DataFrame


def daily_ads(clicks: DataFrame, scratch: str, threshold: int = ads.BLACKLIST_THRESHOLD) -> DailyAds:
    """Count all clicks per user, then the clicks of users who never reach ``threshold`` per city and province.

    The log is read once, into one count per (date, province, city, user, ad), and all tables add up
    from it; a user or ad with a large share of the clicks is small before anything is joined. The counts stay in
    ``scratch`` (see ``session.scratch_folder``) as long as the tables are read.
    """
    cells = stored(ads.click_cells(clicks), f"{scratch}/cells")
    user_counts = ads.user_click_counts(cells)
    blacklist = stored(ads.over_clicking_users(user_counts, threshold), f"{scratch}/blacklist")
    city_counts = ads.city_click_counts(ads.without_users(cells, blacklist))
    return DailyAds(
        user_counts, blacklist, city_counts, ads.province_top_ads(ads.province_click_counts(city_counts))
    )

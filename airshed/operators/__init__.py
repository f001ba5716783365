"""DataFrame -> DataFrame operators."""

from airshed.operators.correlate import exposure_weather_corr, per_day_pollution, safe_corr  # noqa: F401
from airshed.operators.dates import all_dates, distinct_dates  # noqa: F401
from airshed.operators.estimates import build_lookup, first_match, lookup_problems  # noqa: F401
from airshed.operators.exposure import (  # noqa: F401
    country_exposure, dedup_readings, distinct_rows_by_key_set, exposure_per_city, exposure_per_country, in_city, on_day,
    top_exposed_days, weighted_exposure,
)
from airshed.operators.inventory import copy_count, dates_from_keys, drop_markers, graft_plan, remap_plan  # noqa: F401
from airshed.operators.joins import bounded_broadcast, enrich, lookup_with_status  # noqa: F401
from airshed.operators.ledger import (  # noqa: F401
    account, last_wins, ledger_rows, select_notices, split_poison,
)
from airshed.operators.maintained import MaintainedExposure, co_moments, corr_of_moments, merged_moments  # noqa: F401
from airshed.operators.quality import profile  # noqa: F401
from airshed.operators.weather import daily_weather, hourly_weather, normalise_readings  # noqa: F401

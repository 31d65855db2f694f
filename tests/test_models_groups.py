"""P19 feature groups."""

import pytest

from hourcast.operators.models import FEATURE_GROUPS, feature_group

NUMERIC = ["pm25_latest", "PM2.5_lag_1", "co_24h_mean", "temp_delta_1h", "wind_u", "has_rain_lag1",
           "pressure_change_24h", "temperature_acceleration_3h", "hour", "sin_month", "coarse"]


def test_groups_nest_and_go_by_family():
    got = {g: feature_group(NUMERIC, ["station"], g) for g in FEATURE_GROUPS}
    assert got["pollution_only"] == (["pm25_latest", "PM2.5_lag_1", "co_24h_mean"], [])
    assert got["pollution_weather"][0] == NUMERIC[:5]
    assert got["pollution_weather_calendar"][0] == [*NUMERIC[:5], "hour", "sin_month"]
    assert got["all_features"] == (NUMERIC, ["station"])


def test_unknown_group():
    with pytest.raises(ValueError, match="unknown feature group"):
        feature_group(NUMERIC, [], "everything")

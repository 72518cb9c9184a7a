from __future__ import annotations

from fareweather.sources.periods import default_periods, enumerate_periods, year_frame


def test_default_periods_end_in_april_2024(spark):
    periods = default_periods(spark)
    assert len(periods) == 28
    assert periods[0] == (2022, 1) and periods[-1] == (2024, 4)
    assert [sum(year == y for y, _ in periods) for year in (2022, 2023, 2024)] == [12, 12, 4]


def test_given_months_apply_to_every_year(spark):
    assert default_periods(spark, [2022, 2024], [1, 11]) == [(2022, 1), (2022, 11), (2024, 1), (2024, 11)]


def test_single_numbers(spark):
    assert default_periods(spark, 2022, 1) == [(2022, 1)]


def test_columns(spark):
    assert enumerate_periods(year_frame(spark, 2023)).dtypes == [("year", "int"), ("month", "int")]

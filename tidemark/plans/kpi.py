"""Business KPIs on the station-hour star."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.measures import ratio
from tidemark.operators.dims import static_dim

# KPI codes with their names and targets in the report.
KPI_NAMES = {
    "A": "Mức mất cân bằng xe trung bình mỗi trạm/giờ (AVG abs_imbalance)",
    "B": "Tỷ lệ station-hour mất cân bằng nghiêm trọng (abs_imbalance ≥ 4)",
    "C": "Số lần trạm–ngày rút cạn kéo dài hơn 6 tiếng (net_flow < 0)",
    "D": "Mức mất cân bằng giờ cao điểm (07:00–08:00 và 17:00–18:00 vào ngày thường) so với giờ thường",
    "E": "Chênh lệch mất cân bằng trung bình giữa Chicago và New York (|AVG_CHI − AVG_NYC|)",
    "F": "Chênh lệch mất cân bằng khi trời mưa so với trời quang (AVG_Rain − AVG_Clear)",
    "G": "Số chuyến đi bắt đầu trung bình mỗi trạm/giờ (AVG trips_started)",
    "H": "Tỷ lệ chuyến đi Member/Casual (SUM member ÷ SUM casual)",
    "I": "Tỷ lệ sử dụng xe điện trên tổng chuyến classic + electric",
    "J": "Mức sụt giảm nhu cầu khi mưa/tuyết so với trời quang (% giảm AVG trips_started)",
    "K": "Tổng số chuyến đi bắt đầu theo thành phố (CHI / NYC)",
}
KPI_TARGETS = {
    "A": 4.0,
    "B": 10.0,
    "C": 5.0,
    "D": 1.5,
    "E": 1.0,
    "F": None,
    "G": 3.0,
    "H": 2.0,
    "I": 30.0,
    "J": 15.0,
    "K": None,
}


@dataclass(frozen=True)
class KpiSettings:
    """Thresholds and compared members. ``period`` is the column reported per row."""

    serious: int = 4
    depleted_hours: int = 6
    cities: tuple[str, str] = ("CHI", "NYC")
    period: str = "month"


def star_join(
    fact: DataFrame, dim_datetime: DataFrame, dim_station: DataFrame, dim_city: DataFrame, dim_weather: DataFrame
) -> DataFrame:
    """Fact with its snowflake dimensions. Filters on them prune the joined rows."""
    station = dim_station.select("station_sk", "city_sk", "source_station_id", "station_status", "capacity")
    city = dim_city.select("city_sk", "city_code", "city_name")
    weather = dim_weather.select("weather_condition_sk", "weather_category", "precipitation_band")
    return (
        fact.join(dim_datetime, "datetime_sk")
        .join(station, "station_sk")
        .join(city, "city_sk")
        .join(weather, "weather_condition_sk")
    )


def report_base(star: DataFrame, year: int, months: tuple[int, int] = (1, 5)) -> DataFrame:
    return star.filter((F.col("year") == year) & F.col("month").between(*months))


def _station_days(base: DataFrame, s: KpiSettings) -> DataFrame:
    """Whole-number sums and counts per station-day: the only pass over the fact rows.

    All KPIs are ratios of these sums, so the second step works on few rows and its
    results are exact.
    """
    imb, n = F.col("abs_imbalance"), F.lit(1)
    peak = F.col("is_peak_hour")
    rain, snow, clear = (F.col("weather_category") == w for w in ("Rain", "Snow", "Clear"))

    def pair(name: str, cond: Column, value: Column) -> list[Column]:
        return [F.sum(F.when(cond, value)).alias(f"{name}_sum"), F.count_if(cond).alias(f"{name}_n")]

    return base.groupBy("station_sk", "date", s.period, "city_code").agg(
        F.count(n).alias("hours"),
        F.sum(imb).alias("imb"),
        F.count_if(imb >= s.serious).alias("serious"),
        F.count_if(F.col("net_flow") < 0).alias("depleted"),
        *pair("peak", peak, imb),
        *pair("off", ~peak, imb),
        *pair("rain", rain, imb),
        *pair("clear", clear, imb),
        *pair("dry_trips", clear, F.col("trips_started")),
        *pair("wet_trips", rain | snow, F.col("trips_started")),
        *[
            F.sum(c).alias(c)
            for c in (
                "trips_started",
                "member_trip_count",
                "casual_trip_count",
                "electric_trip_count",
                "classic_trip_count",
            )
        ],
    )


def kpi_wide(base: DataFrame, s: KpiSettings = KpiSettings()) -> DataFrame:
    """One row per period and for the whole span, one column per KPI.

    The whole span is recomputed from all rows, never averaged from the periods.
    ``city_code`` is NULL but in the rows that carry K.
    """
    days = _station_days(base, s)
    one, other = s.cities

    def total(c: str) -> Column:
        return F.sum(c)

    def mean(name: str) -> Column:
        return ratio(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    def city_mean(code: str) -> Column:
        here = F.col("city_code") == code
        return ratio(F.sum(F.when(here, F.col("imb"))), F.sum(F.when(here, F.col("hours"))))

    wide = days.groupingSets(
        [[F.col(s.period), F.col("city_code")], [F.col(s.period)], [F.col("city_code")], []],
        s.period,
        "city_code",
    ).agg(
        F.grouping(s.period).alias("all_periods"),
        F.grouping("city_code").alias("all_cities"),
        ratio(total("imb"), total("hours")).alias("A"),
        (ratio(total("serious"), total("hours")) * 100).alias("B"),
        F.count_if(F.col("depleted") > s.depleted_hours).cast("double").alias("C"),
        ratio(mean("peak"), mean("off")).alias("D"),
        F.abs(city_mean(one) - city_mean(other)).alias("E"),
        (mean("rain") - mean("clear")).alias("F"),
        ratio(total("trips_started"), total("hours")).alias("G"),
        ratio(total("member_trip_count"), total("casual_trip_count")).alias("H"),
        (ratio(total("electric_trip_count"), total("electric_trip_count") + total("classic_trip_count")) * 100).alias(
            "I"
        ),
        (ratio(mean("dry_trips") - mean("wet_trips"), mean("dry_trips")) * 100).alias("J"),
        total("trips_started").cast("double").alias("K"),
    )
    period = F.when(F.col("all_periods") == 1, "YTD").otherwise(F.col(s.period).cast("string"))
    return wide.withColumn("period", period)


def kpi_all(base: DataFrame, s: KpiSettings = KpiSettings(), codes: Sequence[str] = tuple(KPI_NAMES)) -> DataFrame:
    """kpi_code, kpi_name, period, city_code, actual_value. Only K is split by city.

    A count KPI has no row for a period without counted rows, as in a grouped count.
    """
    wide = kpi_wide(base, s)
    entries = []
    for code in codes:
        cities = F.col("all_cities") == (0 if code == "K" else 1)
        if code == "C":
            cities = cities & ((F.col("all_periods") == 1) | (F.col("C") > 0))
        entry = F.struct(
            F.lit(code).alias("kpi_code"),
            F.lit(KPI_NAMES[code]).alias("kpi_name"),
            F.col("period"),
            F.col("city_code"),
            F.col(code).alias("actual_value"),
        )
        entries.append(F.when(cities, entry))
    return wide.select(F.explode(F.array_compact(F.array(*entries))).alias("k")).select("k.*")


def report_order(kpis: DataFrame) -> DataFrame:
    """Code, period with the whole span last, city with NULL first."""
    rank = F.when(F.col("period") == "YTD", 99).otherwise(F.col("period").try_cast("int"))
    return kpis.orderBy("kpi_code", rank, F.asc_nulls_first("city_code"))


def kpi(base: DataFrame, code: str, s: KpiSettings = KpiSettings()) -> DataFrame:
    """One KPI; the columns of the others are pruned from the plan."""
    return kpi_all(base, s, [code])


def targets_frame(spark: SparkSession, targets: Mapping[str, float | None] = KPI_TARGETS) -> DataFrame:
    return static_dim(spark, list(targets.items()), "kpi_code string, target double")


def plan_actual(kpis: DataFrame, targets: DataFrame, periods: Sequence[str]) -> DataFrame:
    """Wide report: target and one column per period."""
    cols = [*periods, "YTD"]
    wide = kpis.groupBy("kpi_code", "city_code").pivot("period", cols).agg(F.first("actual_value"))
    named = wide.select("kpi_code", "city_code", *[F.col(p).alias(f"p_{p}") for p in cols])
    return targets.join(named, "kpi_code", "left")


def sanity(kpis: DataFrame, codes: Sequence[str], periods: Sequence[str], cities: Sequence[str]) -> DataFrame:
    """Missing, NULL or infinite cells of the expected code x period (x city) grid."""
    spark = kpis.sparkSession
    grid = [(c, p, t) for c in codes for p in [*periods, "YTD"] for t in (cities if c == "K" else [None])]
    expected = static_dim(spark, grid, "kpi_code string, period string, city_code string")
    k = kpis.select("kpi_code", "period", "city_code", "actual_value", F.lit(True).alias("__hit")).alias("k")
    e = expected.alias("e")
    on = (F.col("e.kpi_code") == F.col("k.kpi_code")) & (F.col("e.period") == F.col("k.period"))
    joined = e.join(k, on & F.col("e.city_code").eqNullSafe(F.col("k.city_code")), "left")
    value = F.col("actual_value")
    endless = (F.abs(value) == float("inf")) | F.isnan(value)
    problem = F.when(F.col("__hit").isNull(), "missing").when(value.isNull(), "NULL").when(endless, "Inf")
    return joined.select("e.kpi_code", "e.period", "e.city_code", problem.alias("problem")).filter("problem is not null")


def city_imbalance(base: DataFrame) -> DataFrame:
    return base.groupBy("city_code").agg(
        ratio(F.sum("abs_imbalance"), F.count(F.lit(1))).alias("city_imbalance_score")
    )


def weather_sensitivity(base: DataFrame) -> DataFrame:
    """Percent fewer trips per station-hour in rain or snow than under a clear sky."""
    clear = F.col("weather_category") == "Clear"
    wet = F.col("weather_category").isin("Rain", "Snow")

    def mean(cond):
        return ratio(F.sum(F.when(cond, F.col("trips_started"))), F.count_if(cond))

    return base.groupBy("city_code").agg(
        (ratio(mean(clear) - mean(wet), mean(clear)) * 100).alias("weather_sensitivity_pct")
    )


def drain_overflow(base: DataFrame) -> DataFrame:
    """Draining and overflowing station-hours by time band."""
    hour = F.col("hour")
    band = (
        F.when(hour.between(6, 9), "morning")
        .when(hour.between(10, 15), "midday")
        .when(hour.between(16, 19), "evening")
        .otherwise("night")
    )
    return base.groupBy("station_sk", band.alias("time_band")).agg(
        F.count_if(F.col("net_flow") < 0).alias("drain_hours"),
        F.count_if(F.col("net_flow") > 0).alias("overflow_hours"),
        F.sum("net_flow").alias("net_flow"),
    )


def weather_hour_effect(base: DataFrame) -> DataFrame:
    return base.groupBy("weather_category", "hour").agg(
        F.sum("trips_started").alias("trips_started"),
        ratio(F.sum("trips_started"), F.count(F.lit(1))).alias("avg_trips"),
        ratio(F.sum("abs_imbalance"), F.count(F.lit(1))).alias("avg_imbalance"),
    )


def season_imbalance(base: DataFrame) -> DataFrame:
    return base.groupBy("season", "station_sk").agg(
        ratio(F.sum("abs_imbalance"), F.count(F.lit(1))).alias("avg_imbalance")
    )


def member_mix(base: DataFrame) -> DataFrame:
    return base.groupBy("is_weekend", "hour").agg(
        F.sum("member_trip_count").alias("member_trips"), F.sum("casual_trip_count").alias("casual_trips")
    )


def electric_share(base: DataFrame) -> DataFrame:
    both = F.sum("electric_trip_count") + F.sum("classic_trip_count")
    return base.groupBy("station_sk").agg((ratio(F.sum("electric_trip_count"), both) * 100).alias("electric_pct"))


def city_ranking(base: DataFrame) -> DataFrame:
    """Cities from most to least imbalanced."""
    scores = city_imbalance(base)
    return scores.orderBy(F.desc("city_imbalance_score"), "city_code")


def dashboard(base: DataFrame) -> DataFrame:
    """Totals, by month of year and by city, in one pass."""
    out = base.groupingSets(
        [[F.col("year"), F.col("month_name")], [F.col("city_name")], []], "year", "month_name", "city_name"
    ).agg(
        F.grouping_id().alias("__g"),
        F.sum("trips_started").alias("trips_started"),
        F.sum("trips_ended").alias("trips_ended"),
        F.sum("abs_imbalance").alias("abs_imbalance"),
    )
    view = F.when(F.col("month_name").isNotNull(), "month").when(F.col("city_name").isNotNull(), "city")
    return out.withColumn("view", view.otherwise("total")).drop("__g")

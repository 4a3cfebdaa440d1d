"""Checks of cube operations and KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import check
from tidemark.checks.views import Tables
from tidemark.functions.measures import ratio
from tidemark.operators.ordered import rank_rows
from tidemark.plans import cells
from tidemark.plans import cube as olap
from tidemark.plans import kpi
from tidemark.session import scratch_path

# ---- cube over the bike star, and over the order tables ----

MEASURES = [
    "trips_started",
    "trips_ended",
    "member_trip_count",
    "casual_trip_count",
    "electric_trip_count",
    "classic_trip_count",
    "net_flow",
    "abs_imbalance",
]


def sums(names: list[str]) -> str:
    return ", ".join(f"sum({m})::bigint as {m}" for m in names)


def bike(t: Tables) -> olap.Cube:
    return olap.bike_cube(t.star)


def orders_cube(t: Tables) -> olap.Cube:
    cust = t.customer.select("c_custkey", "c_nationkey")
    nation = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    region = t.region.select("r_regionkey", "r_name")
    star = (
        t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.year("o_orderdate").alias("year"),
            F.quarter("o_orderdate").alias("quarter"),
            F.month("o_orderdate").alias("month"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("nation"),
            F.col("o_custkey").alias("customer"),
            F.col("o_orderpriority").alias("band"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
            F.lit(1).alias("orders"),
        )
    )
    return olap.Cube(
        star,
        {"time": ["year", "quarter", "month"], "geography": ["region", "nation", "customer"], "band": ["band"]},
        ["revenue", "orders"],
        {"customer": ["region", "nation"]},
    )


ORDER_STAR = """
select year(o_orderdate) as year, quarter(o_orderdate) as quarter, month(o_orderdate) as month, r_name as region,
  n_name as nation, o_custkey as customer, o_orderpriority as band, o_totalprice::decimal(18,2) as revenue
from orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey
  join region on r_regionkey = n_regionkey"""
ORDER_SUMS = "round(sum(revenue)::double, 6) as revenue, count(*) as orders"


@check(
    "olap_hypercube",
    f"select year, quarter, month, city_name, weather_category, {sums(MEASURES)} from star group by 1, 2, 3, 4, 5",
)
def _(t: Tables):
    c = bike(t)
    return olap.hypercube(c, [*c.level_path("month"), "city_name", "weather_category"])


@check(
    "olap_rollup",
    f"select year, quarter, month, grouping_id(year, quarter, month) as level_id, {ORDER_SUMS} from ({ORDER_STAR}) s"
    " group by rollup (year, quarter, month)",
)
def _(t: Tables):
    return olap.rollup(orders_cube(t), "time")


@check(
    "olap_roll_up_quarter",
    "select year, quarter, city_name, sum(trips_started)::bigint as trips_started from star group by 1, 2, 3",
)
def _(t: Tables):
    return olap.roll_up(bike(t), "quarter", ["city_name"], ["trips_started"])


@check(
    "olap_drilldown",
    f"select year, quarter, month, band, {ORDER_SUMS} from ({ORDER_STAR}) s where year = 1998 group by 1, 2, 3, 4",
)
def _(t: Tables):
    return olap.drill_down(orders_cube(t), {"year": 1998}, "month", ["band"])


@check(
    "olap_slice",
    "select month, city_name, sum(trips_started)::bigint as trips_started from star where weather_category = 'Rain'"
    " group by 1, 2",
)
def _(t: Tables):
    return olap.slice_cube(bike(t), "weather_category", "Rain", ["month", "city_name"], ["trips_started"])


@check(
    "olap_dice",
    "select month, city_name, weather_category, sum(trips_started)::bigint as trips_started from star where month in"
    " (4, 5) and city_name in ('Chicago', 'New York City') and weather_category in ('Clear', 'Rain') group by 1, 2, 3",
)
def _(t: Tables):
    members = {
        "month": [4, 5],
        "city_name": ["Chicago", "New York City"],
        "weather_category": ["Clear", "Rain"],
    }
    return olap.dice(bike(t), members, list(members), ["trips_started"])


@check(
    "olap_pivot",
    "select weather_category, sum(trips_started) filter (city_code = 'CHI')::bigint as \"CHI\","
    " sum(trips_started) filter (city_code = 'NYC')::bigint as \"NYC\" from star group by 1",
)
def _(t: Tables):
    return olap.pivot(bike(t), "weather_category", "city_code", ["CHI", "NYC"], "trips_started")


@check(
    "olap_multi_measure",
    f"select city_name, {sums(MEASURES[2:6])} from star where year = 2024 and weather_category = 'Rain' group by 1",
)
def _(t: Tables):
    where = (F.col("year") == 2024) & (F.col("weather_category") == "Rain")
    return olap.hypercube(bike(t), ["city_name"], MEASURES[2:6], where)


@check(
    "olap_top_stations",
    "select station_sk, source_station_id, station_status, capacity, sum(trips_started)::bigint as trips_started from"
    " star group by 1, 2, 3, 4 order by trips_started desc, station_sk limit 20",
)
def _(t: Tables):
    return olap.top_members(bike(t), "station_sk", "trips_started", 20)


@check(
    "olap_net_flow",
    "select station_sk, source_station_id, station_status, capacity, sum(net_flow)::bigint as net_flow,"
    " sum(abs_imbalance)::bigint as abs_imbalance from star group by 1, 2, 3, 4"
    " order by abs_imbalance desc, station_sk limit 20",
)
def _(t: Tables):
    return olap.top_members(bike(t), "station_sk", "abs_imbalance", 20, ["net_flow", "abs_imbalance"])


@check(
    "olap_cube_all",
    "select case when grouping(region) = 1 then 'All' else region end as region, case when grouping(band) = 1 then 'All'"
    " else band end as band, case when grouping(year) = 1 then 'All' else year::varchar end as year,"
    f" {ORDER_SUMS} from ({ORDER_STAR}) s group by cube (region, band, year)",
)
def _(t: Tables):
    return olap.cube_all(orders_cube(t), ["region", "band", "year"])


@check(
    "olap_cells_daily",
    "select case when grouping(region) = 1 then 'All' else region end as region, case when grouping(band) = 1 then 'All'"
    " else band end as band, case when grouping(year) = 1 then 'All' else year::varchar end as year,"
    f" {ORDER_SUMS} from ({ORDER_STAR}) s group by cube (region, band, year)",
)
def _(t: Tables):
    """The cube of all orders from cells kept by load: two loads, a correction of a tenth of the rows, a fold between."""
    star = orders_cube(t).star
    kept = cells.cells_of(star, scratch_path(t.spark, "cells"), ["region", "band", "year"], ["revenue", "orders"])
    tenth = F.col("customer") % 10 == 3
    wrong = star.withColumns({"revenue": F.when(tenth, F.col("revenue") + 5).otherwise(F.col("revenue")).cast("decimal(18,2)"),
                              "year": F.when(tenth, F.col("year") - 1).otherwise(F.col("year"))})
    kept.add(1, wrong.filter("month <= 6"))
    kept.add(2, star.filter("month > 6"))
    kept.fold()
    kept.add(3, star.filter(tenth & (F.col("month") <= 6)), wrong.filter(tenth & (F.col("month") <= 6)))
    return olap.cube_all(kept.cube(), ["region", "band", "year"])


# ---- KPIs; the thresholds fit the sparse synthetic trips ----

SETTINGS = kpi.KpiSettings(serious=2, depleted_hours=2)


def base(t: Tables) -> DataFrame:
    return kpi.report_base(t.star, 2024)


BASE = {"base": "select * from star where year = 2024 and month between 1 and 5"}


def mean(what: str, cond: str) -> str:
    return f"avg({what}) filter ({cond})"


RAIN, CLEAR, WET = "weather_category = 'Rain'", "weather_category = 'Clear'", "weather_category in ('Rain', 'Snow')"
FORMULAS = {
    "A": "avg(abs_imbalance)",
    "B": "100.0 * count(*) filter (abs_imbalance >= 2) / count(*)",
    "D": f"{mean('abs_imbalance', 'is_peak_hour')} / nullif({mean('abs_imbalance', 'not is_peak_hour')}, 0)",
    "E": "abs(" + mean("abs_imbalance", "city_code = 'CHI'") + " - " + mean("abs_imbalance", "city_code = 'NYC'") + ")",
    "F": f"{mean('abs_imbalance', RAIN)} - {mean('abs_imbalance', CLEAR)}",
    "G": "sum(trips_started) / count(*)",
    "H": "sum(member_trip_count) / nullif(sum(casual_trip_count), 0)",
    "I": "100.0 * sum(electric_trip_count) / nullif(sum(electric_trip_count) + sum(classic_trip_count), 0)",
    "J": f"({mean('trips_started', CLEAR)} - {mean('trips_started', WET)}) * 100 /"
    f" nullif({mean('trips_started', CLEAR)}, 0)",
}


def kpi_sql(code: str) -> str:
    name = kpi.KPI_NAMES[code].replace("'", "''")
    head = f"select '{code}' as kpi_code, '{name}' as kpi_name"
    period = "coalesce(month::varchar, 'YTD') as period"
    if code == "K":
        return (
            f"{head}, {period}, city_code, sum(trips_started)::double as actual_value from base"
            " group by grouping sets ((month, city_code), (city_code))"
        )
    if code == "C":
        return (
            f"{head}, {period}, null::varchar as city_code, count(*)::double as actual_value from (select station_sk,"
            " date, month from base group by 1, 2, 3 having count(*) filter (net_flow < 0) > 2) d"
            " group by grouping sets ((month), ())"
        )
    return (
        f"{head}, {period}, null::varchar as city_code, round(({FORMULAS[code]})::double, 6) as actual_value"
        " from base group by grouping sets ((month), ())"
    )


def _register(code: str) -> None:
    @check(f"kpi_{code.lower()}", kpi_sql(code), **BASE)
    def _(t: Tables):
        return kpi.kpi(base(t), code, SETTINGS)


for _code in kpi.KPI_NAMES:
    _register(_code)

ALL_SQL = "\nunion all\n".join(kpi_sql(c) for c in kpi.KPI_NAMES)


@check("kpi_all", ALL_SQL, **BASE)
def _(t: Tables):
    return kpi.report_order(kpi.kpi_all(base(t), SETTINGS))


@check(
    "kpi_plan_actual",
    f"""select t.kpi_code, target, city_code, {", ".join(
        f"max(actual_value) filter (period = '{p}') as p_{p}" for p in ("1", "2", "3", "4", "5", "YTD"))}
from (values {", ".join(f"('{c}', {'null::double' if v is None else v}::double)" for c, v in kpi.KPI_TARGETS.items())})
  t(kpi_code, target) left join ({ALL_SQL}) k on k.kpi_code = t.kpi_code group by 1, 2, 3""",
    **BASE,
)
def _(t: Tables):
    kpis = kpi.kpi_all(base(t), SETTINGS)
    return kpi.plan_actual(kpis, kpi.targets_frame(t.spark), ["1", "2", "3", "4", "5"])


@check(
    "kpi_sanity",
    f"""select g.kpi_code, g.period, g.city_code, case when k.kpi_code is null then 'missing' else 'NULL' end as problem
from (select c as kpi_code, p as period, null::varchar as city_code from (select unnest(['A','B','C','D','E','F','G','H',
    'I','J']) as c) x, (select unnest(['1','2','3','4','5','6','YTD']) as p) y
  union all select 'K', p, z from (select unnest(['1','2','3','4','5','6','YTD']) as p) y,
    (select unnest(['CHI','NYC']) as z) w) g
left join ({ALL_SQL}) k on k.kpi_code = g.kpi_code and k.period = g.period
  and k.city_code is not distinct from g.city_code
where k.actual_value is null""",
    **BASE,
)
def _(t: Tables):
    # Month 6 is outside the base: every KPI misses it.
    kpis = kpi.kpi_all(base(t), SETTINGS)
    return kpi.sanity(kpis, list(kpi.KPI_NAMES), ["1", "2", "3", "4", "5", "6"], ["CHI", "NYC"])


@check(
    "kpi_city_imbalance",
    "select city_code, round(avg(abs_imbalance), 6) as city_imbalance_score from base group by 1",
    **BASE,
)
def _(t: Tables):
    return kpi.city_imbalance(base(t))


@check(
    "kpi_weather_sensitivity",
    f"select city_code, round({FORMULAS['J']}, 6) as weather_sensitivity_pct from base group by 1",
    **BASE,
)
def _(t: Tables):
    return kpi.weather_sensitivity(base(t))


@check(
    "kpi_q_drain_overflow",
    "select station_sk, case when hour between 6 and 9 then 'morning' when hour between 10 and 15 then 'midday'"
    " when hour between 16 and 19 then 'evening' else 'night' end as time_band,"
    " count(*) filter (net_flow < 0) as drain_hours, count(*) filter (net_flow > 0) as overflow_hours,"
    " sum(net_flow)::bigint as net_flow from base group by 1, 2",
    **BASE,
)
def _(t: Tables):
    return kpi.drain_overflow(base(t))


@check(
    "kpi_q_weather_hour",
    "select weather_category, hour, sum(trips_started)::bigint as trips_started,"
    " round(avg(trips_started), 6) as avg_trips, round(avg(abs_imbalance), 6) as avg_imbalance from base group by 1, 2",
    **BASE,
)
def _(t: Tables):
    return kpi.weather_hour_effect(base(t))


@check(
    "kpi_q_season_station",
    "select season, station_sk, round(avg(abs_imbalance), 6) as avg_imbalance from base group by 1, 2",
    **BASE,
)
def _(t: Tables):
    return kpi.season_imbalance(base(t))


@check(
    "kpi_q_member_mix",
    "select is_weekend, hour, sum(member_trip_count)::bigint as member_trips,"
    " sum(casual_trip_count)::bigint as casual_trips from base group by 1, 2",
    **BASE,
)
def _(t: Tables):
    return kpi.member_mix(base(t))


@check(
    "kpi_q_electric_share",
    "select station_sk, round(100.0 * sum(electric_trip_count) / nullif(sum(electric_trip_count)"
    " + sum(classic_trip_count), 0), 6) as electric_pct from base group by 1",
    **BASE,
)
def _(t: Tables):
    return kpi.electric_share(base(t))


@check(
    "kpi_q_city_ranking",
    "select city_code, round(avg(abs_imbalance), 6) as city_imbalance_score, row_number() over (order by"
    " avg(abs_imbalance) desc, city_code) as pos from base group by 1",
    **BASE,
)
def _(t: Tables):
    ranked = kpi.city_ranking(base(t))  # one row per city
    return rank_rows(ranked, [F.lit(0)], [F.desc("city_imbalance_score"), F.col("city_code")], "pos")


@check(
    "kpi_dashboard",
    "select year, month_name, city_name, sum(trips_started)::bigint as trips_started, sum(trips_ended)::bigint as"
    " trips_ended, sum(abs_imbalance)::bigint as abs_imbalance, case when month_name is not null then 'month'"
    " when city_name is not null then 'city' else 'total' end as view from star"
    " group by grouping sets ((year, month_name), (city_name), ())",
)
def _(t: Tables):
    return kpi.dashboard(t.star)


@check(
    "kpi_order_revenue",
    "select year, coalesce(quarter::varchar, 'YTD') as period, round(sum(revenue)::double / count(*), 6) as avg_revenue,"
    f" count(*) as orders from ({ORDER_STAR}) s group by grouping sets ((year, quarter), (year))",
)
def _(t: Tables):
    year, quarter = F.col("year"), F.col("quarter")
    out = orders_cube(t).star.groupingSets([[year, quarter], [year]], year, quarter).agg(
        F.grouping("quarter").alias("g"), ratio(F.sum("revenue"), F.sum("orders")).alias("avg_revenue"),
        F.sum("orders").alias("orders"),
    )
    period = F.when(F.col("g") == 1, "YTD").otherwise(F.col("quarter").cast("string"))
    return out.select("year", period.alias("period"), "avg_revenue", "orders")

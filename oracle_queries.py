"""DuckDB statements equivalent to the registered queries, over the star-schema tables."""

from __future__ import annotations

# Trips and zones as views over the line items and nations; see tripcohorts.sources.star.
_TRIPS = """
trips AS (
  SELECT l_shipdate + to_hours(CAST((l_orderkey * 7 + l_linenumber * 5) % 24 AS INTEGER)) AS ts,
         (CAST(round(l_extendedprice * 100) AS BIGINT) - 400000) * 11 / CAST(1048576 AS DOUBLE) AS fare,
         (CAST(round(l_discount * 100) AS INTEGER) - 1) * l_quantity * CAST(0.078125 AS DOUBLE) AS tip,
         l_quantity * CAST(0.5625 AS DOUBLE) - 1 AS dist,
         nullif(l_partkey % 40, 39) AS pu,
         nullif(l_orderkey % 41, 40) AS dro,
         CASE WHEN l_linenumber <= 5 THEN 1 WHEN l_linenumber = 6 THEN 2 END AS pay
  FROM lineitem)"""
_ZONES = """
zones AS (
  SELECT n_nationkey AS id, r_name AS borough, n_name AS zone
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey)"""

_RATIO = "CASE WHEN fare > 0 THEN tip / fare END"
_USUAL = f"fare > 0 AND fare < 100 AND tip >= 0 AND tip < 25 AND dist > 0 AND dist < 25 AND {_RATIO} <= 1"
_COHORT_OF_MONTH = """CASE WHEN month(ts) IN (1, 11, 12) THEN 'Holiday Season'
            WHEN month(ts) IN (3, 4, 9, 10) THEN 'Normal Baseline' END"""
_COHORT_OF_DAY = """CASE WHEN CAST(ts AS DATE) BETWEEN DATE '1998-12-01' AND DATE '1998-12-31' THEN 'Holiday Season'
            WHEN CAST(ts AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1998-03-31' THEN 'Normal Baseline' END"""

# Card trips of the month cohorts, with borough and zone.
_MONTH = f"""WITH {_TRIPS}, {_ZONES},
card AS (
  SELECT {_COHORT_OF_MONTH} AS study_period,
         CAST(hour(ts) AS INTEGER) AS pickup_hour,
         CASE WHEN pu IS NULL OR dro IS NULL THEN 'Non-Airport'
              WHEN pu IN (1, 3, 8) AND dro IN (1, 3, 8) THEN 'Airport-to-Airport'
              WHEN pu IN (1, 3, 8) THEN 'Airport Inbound'
              WHEN dro IN (1, 3, 8) THEN 'Airport Outbound'
              ELSE 'Non-Airport' END AS airport_direction,
         borough, zone, fare, tip, dist, {_RATIO} AS rate
  FROM trips LEFT JOIN zones ON pu = id
  WHERE pay = 1 AND {_USUAL} AND year(ts) BETWEEN 1996 AND 1998),
cohort_trips AS (SELECT * FROM card WHERE study_period IS NOT NULL)
"""
# Study rows of the date cohorts before cleaning; cleaned trips with borough and zone.
_DAY = f"""WITH {_TRIPS}, {_ZONES},
study AS (
  SELECT *, {_COHORT_OF_DAY} AS period, {_RATIO} AS rate FROM trips
  WHERE {_COHORT_OF_DAY} IS NOT NULL),
cleaned AS (
  SELECT * FROM study WHERE {_USUAL} AND pu IS NOT NULL AND dro IS NOT NULL AND pay IS NOT NULL),
joined AS (
  SELECT cleaned.*, CAST(hour(ts) AS INTEGER) AS pickup_hour,
         borough AS pickup_borough, zone AS pickup_zone,
         CASE WHEN pu IN (1, 3, 8) OR dro IN (1, 3, 8) THEN 'Airport Trip'
              ELSE 'Non-Airport Trip' END AS airport_trip_flag
  FROM cleaned LEFT JOIN zones ON pu = id)
"""

_MEAN = {
    "tip": "round(avg(tip), 2) AS avg_tip_amount",
    "rate": "round(avg(rate), 4) AS avg_tip_rate",
    "fare": "round(avg(fare), 2) AS avg_fare_amount",
    "dist": "round(avg(dist), 2) AS avg_trip_distance",
}
_ALL = ("tip", "rate", "fare", "dist")


def _cut(source: str, keys: str, where: str = "TRUE", means=_ALL, having: str = "TRUE") -> str:
    chosen = ", ".join(_MEAN[m] for m in means)
    return (
        f"SELECT {keys}, count(*) AS trip_count, {chosen} FROM {source} WHERE {where} "
        f"GROUP BY {keys} HAVING {having}"
    )


def _month_cut(keys: str, where: str = "TRUE", order: str = "") -> str:
    return f"{_MONTH} {_cut('cohort_trips', keys, where)} ORDER BY {order or keys}"


def _day_cut(keys: str, where: str = "pay = 1", means=_ALL, having: str = "TRUE", order: str = "") -> str:
    return f"{_DAY} {_cut('joined', keys, where, means, having)} ORDER BY {order or keys}"


def _in_place(statement: str) -> str:
    """The rows of an ordered statement with their place in its order."""
    rows, order = statement.rsplit(" ORDER BY ", 1)
    head, select = rows.rsplit("SELECT ", 1)
    return f"{head} SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM (SELECT {select})"


def _controlled(strata: str, least: int = 10) -> str:
    return f"""{_MONTH}, strata AS (
  SELECT {strata},
         count(*) FILTER (study_period = 'Holiday Season') AS holiday_trips,
         count(*) FILTER (study_period = 'Normal Baseline') AS baseline_trips,
         avg(rate) FILTER (study_period = 'Holiday Season') AS h,
         avg(rate) FILTER (study_period = 'Normal Baseline') AS b
  FROM cohort_trips WHERE borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE') GROUP BY {strata})
SELECT {strata}, holiday_trips, baseline_trips, round(h, 4) AS holiday_tip_rate,
       round(b, 4) AS baseline_tip_rate, round(h - b, 4) AS tip_rate_difference
FROM strata WHERE least(holiday_trips, baseline_trips) >= {least}
ORDER BY abs(h - b) DESC, {strata} LIMIT 20"""


def _percentiles(ps: tuple[float, ...]) -> str:
    columns = {"fare_amount": "fare", "tip_amount": "tip", "trip_distance": "dist", "raw_tip_rate": "rate"}
    rows = [
        f"SELECT '{name}' AS \"column\", CAST({p} AS DOUBLE) AS p, quantile_disc({column}, {p}) AS value FROM study"
        for name, column in columns.items()
        for p in ps
    ]
    return _DAY + " UNION ALL ".join(rows) + ' ORDER BY "column", p'


_PROFILED = (("fare_amount", "fare"), ("tip_amount", "tip"), ("trip_distance", "dist"), ("raw_tip_rate", "rate"))

_MOMENTS = _DAY + " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max FROM study"
    for name, c in _PROFILED
)


_PROFILE = _DAY + " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max, quantile_disc({c}, 0.25) AS q25, "
    f"quantile_disc({c}, 0.5) AS q50, quantile_disc({c}, 0.75) AS q75 FROM study"
    for name, c in _PROFILED
) + ' ORDER BY "column"'

_RANKS = _DAY + " UNION ALL ".join(
    f"SELECT '{name}' AS \"column\", CAST({p} AS DOUBLE) AS p, count({c}) > 0 AS within_error FROM study"
    for name, c in _PROFILED
    for p in (0.5, 0.75, 0.9, 0.95, 0.99)
) + ' ORDER BY "column", p'


def _sum_if(condition: str, name: str) -> str:
    return f"count(*) FILTER ({condition}) AS {name}"


_DEFECTS = ", ".join(
    _sum_if(condition, name)
    for condition, name in (
        ("fare <= 0", "non_positive_fare"),
        ("tip < 0", "negative_tip"),
        ("dist <= 0", "non_positive_distance"),
        ("pu IS NULL", "missing_pickup_location"),
        ("dro IS NULL", "missing_dropoff_location"),
        ("pay IS NULL", "missing_payment_type"),
    )
)


def _day_report(cut: str, select: str) -> str:
    return f"{_DAY}, summary AS ({cut}) {select}"


_BY_PERIOD = _cut("joined", "period", "pay = 1")
_BY_BOROUGH = _cut("joined", "period, pickup_borough", "pay = 1", ("tip", "rate", "fare"))
_BY_AIRPORT = _cut("joined", "period, airport_trip_flag", "pay = 1")
_BY_HOUR = _cut("joined", "period, pickup_hour", "pay = 1", ("tip", "rate"))


def _pivot(index: str, where: str = "TRUE") -> str:
    return f"""SELECT {index},
  avg(avg_tip_rate * 100) FILTER (period = 'Holiday Season') AS "Holiday Season",
  avg(avg_tip_rate * 100) FILTER (period = 'Normal Baseline') AS "Normal Baseline"
FROM summary WHERE {where} GROUP BY {index} ORDER BY {index}"""


_H = "max({0}) FILTER (period = 'Holiday Season')"
_B = "max({0}) FILTER (period = 'Normal Baseline')"

_DIRECTION = _month_cut("study_period, airport_direction", order="study_period, trip_count DESC, airport_direction")
_TOP_ZONES = _day_cut(
    "period, pickup_borough, pickup_zone",
    means=("tip", "rate", "fare"),
    having="count(*) >= 10",
    order="period, avg_tip_rate DESC, pickup_borough, pickup_zone",
)

# Means of cents by whole numbers, rounded half up; of ratios by a compensated sum.
_PRICES = f"""WITH prices AS (
  SELECT coalesce({_COHORT_OF_MONTH.replace("ts", "l_shipdate")}, 'Other') AS study_period, l_returnflag,
         CAST(round(l_extendedprice * 100) AS HUGEINT) AS price, CAST(round(l_discount * 100) AS HUGEINT) AS discount,
         l_extendedprice / nullif(l_quantity, 0) AS ratio
  FROM lineitem)
SELECT study_period, l_returnflag, count(*) AS trip_count,
       CAST((2 * sum(price) + count(price)) // (2 * count(price)) AS DOUBLE) / 100 AS avg_price,
       CAST((20000 * sum(discount) + count(discount)) // (2 * count(discount)) AS DOUBLE) / 1000000 AS avg_discount,
       round(favg(ratio), 4) AS avg_unit_price
FROM prices GROUP BY study_period, l_returnflag ORDER BY study_period, l_returnflag"""

ORACLE: dict[str, str] = {
    # month-set study
    "total_row_count": "SELECT count(*) AS total_rows FROM lineitem",
    "period_summary": _month_cut("study_period"),
    "airport_direction": _DIRECTION,
    "airport_direction_in_place": _in_place(_DIRECTION),
    "tip_rate_by_hour": _month_cut("study_period, pickup_hour"),
    "tip_rate_by_borough": _month_cut(
        "study_period, borough", "borough IS NOT NULL", "study_period, avg_tip_rate DESC, borough"
    ),
    "borough_rates_by_sql": f"""{_MONTH}
SELECT study_period, borough, count(*) AS trip_count, round(avg(rate), 4) AS avg_tip_rate
FROM cohort_trips WHERE borough IS NOT NULL GROUP BY study_period, borough
ORDER BY study_period, avg_tip_rate DESC, borough""",
    "zone_rows_of_catalog_tables": """SELECT l_partkey % 40 AS zone_id, n_name AS zone, count(*) AS trip_count,
       max(l_extendedprice) AS highest_price
FROM lineitem LEFT JOIN nation ON l_partkey % 40 = n_nationkey
WHERE l_quantity > 1 GROUP BY 1, 2 ORDER BY zone_id""",
    "controlled_comparison": _controlled("borough, pickup_hour"),
    "controlled_comparison_by_zone": _controlled("zone, pickup_hour", 2),
    "month_study_shared_scan": f"""{_MONTH}
SELECT CASE grouping(airport_direction, borough, pickup_hour)
         WHEN 7 THEN 'holiday_vs_baseline' WHEN 3 THEN 'airport_direction' WHEN 6 THEN 'tip_rate_by_hour'
         WHEN 5 THEN 'tip_rate_by_borough' ELSE 'zone_hour_controlled_comparison' END AS cut,
       study_period, airport_direction, borough, pickup_hour, count(*) AS trip_count,
       {", ".join(_MEAN.values())}
FROM cohort_trips GROUP BY GROUPING SETS (
  (study_period), (study_period, airport_direction), (study_period, pickup_hour),
  (study_period, borough), (study_period, borough, pickup_hour))""",
    # labels over all trips
    "trips_by_month_label": f"""WITH {_TRIPS}
SELECT coalesce({_COHORT_OF_MONTH}, 'Other') AS study_period, count(*) AS trip_count FROM trips GROUP BY 1""",
    "trips_by_date_label": f"""WITH {_TRIPS}
SELECT coalesce({_COHORT_OF_DAY}, 'Outside Study Period') AS period, count(*) AS trip_count FROM trips GROUP BY 1""",
    "raw_price_means": _PRICES,
    # raw data quality
    "raw_moments": _MOMENTS,
    "exact_profile": _PROFILE,
    "approx_percentile_ranks": _RANKS,
    "exact_percentiles": _percentiles((0.5, 0.75, 0.9, 0.95, 0.99)),
    "tail_percentiles": _percentiles((0.95, 0.99, 0.995, 0.999, 0.9999)),
    "invalid_record_counts": f"{_DAY} SELECT count(*) AS total_rows, {_DEFECTS} FROM study",
    "invalid_record_counts_all_trips": f"WITH {_TRIPS} SELECT count(*) AS total_rows, {_DEFECTS} FROM trips",
    "high_tip_trips_by_period": f"""{_DAY}
SELECT period, count(*) AS high_tip_trip_count, round(avg(tip), 2) AS avg_high_tip_amount,
       round(avg(rate), 4) AS avg_high_tip_rate, {_MEAN["fare"]}, {_MEAN["dist"]}
FROM study WHERE fare > 0 AND (tip >= 20 OR rate >= 0.5) GROUP BY period ORDER BY period""",
    "row_funnel": f"""{_DAY}
SELECT 'raw' AS stage, count(*) AS n_rows FROM trips
UNION ALL SELECT 'study_period', count(*) FROM study
UNION ALL SELECT 'cleaned', count(*) FROM cleaned
UNION ALL SELECT 'joined', count(*) FROM joined
UNION ALL SELECT 'credit_card', count(*) FROM joined WHERE pay = 1""",
    "join_audit": f"""{_DAY}
SELECT (SELECT count(*) FROM cleaned) AS rows_before, (SELECT count(*) FROM joined) AS rows_after""",
    "repeated_zone_ids": """SELECT CAST(l_partkey % 40 AS BIGINT) AS zone_id, count(*) AS n_rows
FROM lineitem GROUP BY 1 HAVING count(*) > 1""",
    "repeated_lookup_ids": """SELECT CAST(n_nationkey AS BIGINT) AS LocationID, count(*) AS n_rows
FROM nation GROUP BY 1 HAVING count(*) > 1""",
    "clean_joined_trips": f"""{_DAY}
SELECT period, CAST(ts AS DATE) AS pickup_date, CAST(month(ts) AS INTEGER) AS pickup_month, pickup_hour,
       CAST(pay AS BIGINT) AS payment_type, fare AS fare_amount, tip AS tip_amount, dist AS trip_distance,
       rate AS tip_rate, airport_trip_flag, pickup_borough, pickup_zone
FROM joined""",
    # date-range study
    "all_valid_holiday_vs_normal": _day_cut("period", "TRUE"),
    "credit_card_holiday_vs_normal": _day_cut("period"),
    "credit_card_tip_rate_by_borough": _day_cut(
        "period, pickup_borough", means=("tip", "rate", "fare"), order="period, avg_tip_rate DESC, pickup_borough"
    ),
    "credit_card_tip_rate_by_hour": _day_cut("period, pickup_hour", means=("tip", "rate")),
    "credit_card_airport_vs_non_airport": _day_cut("period, airport_trip_flag"),
    "credit_card_top_zones_by_tip_rate": _TOP_ZONES,
    "credit_card_top_zones_in_place": _in_place(_TOP_ZONES),
    # report tables
    "cohort_delta": _day_report(
        _BY_PERIOD,
        f"""SELECT {_H.format("avg_tip_amount")} AS holiday_avg_tip_amount,
  {_H.format("avg_tip_amount")} - {_B.format("avg_tip_amount")} AS tip_amount_delta,
  {_H.format("avg_tip_rate")} * 100 AS holiday_tip_rate_pct,
  ({_H.format("avg_tip_rate")} - {_B.format("avg_tip_rate")}) * 100 AS tip_rate_delta_pts,
  {_H.format("trip_count")} AS holiday_trips, {_B.format("trip_count")} AS baseline_trips
FROM summary""",
    ),
    "cohort_percent": _day_report(
        _BY_PERIOD, "SELECT *, avg_tip_rate * 100 AS avg_tip_rate_percent FROM summary ORDER BY period"
    ),
    "borough_period_pivot": _day_report(
        _BY_BOROUGH, _pivot("pickup_borough", "pickup_borough IS NOT NULL AND pickup_borough <> 'N/A'")
    ),
    "airport_period_pivot": _day_report(_BY_AIRPORT, _pivot("airport_trip_flag")),
    "hour_curve": _day_report(
        _BY_HOUR,
        """SELECT pickup_hour, avg_tip_rate * 100 AS avg_tip_rate_percent FROM summary
WHERE period = 'Holiday Season' ORDER BY pickup_hour""",
    ),
    "period_list": _day_report(_BY_HOUR, "SELECT DISTINCT period FROM summary ORDER BY period"),
    "direction_without_transfers": _month_cut(
        "study_period, airport_direction",
        "airport_direction <> 'Airport-to-Airport'",
        "study_period, trip_count DESC, airport_direction",
    ),
    "real_borough_rates": _month_cut(
        "study_period, borough",
        "borough IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')",
        "study_period, avg_tip_rate DESC, borough",
    ),
}

#: Statements whose row and column order is part of the result; NULL comes last in every order.
ORDERED = tuple(
    name for name, statement in ORACLE.items() if "ORDER BY" in statement and not name.endswith("_in_place")
)

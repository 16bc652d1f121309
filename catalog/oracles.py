"""SQL counterparts of the registered queries, for DuckDB over the same tables.

They share only the inputs (``bindings``) with the Spark side. The KPI texts join first and
aggregate the rows, where the Spark operators aggregate first; rounding is integer half-up.
"""

from __future__ import annotations

import re

from catalog import bindings as B
from catalog import queries as Q
from punctua import schemas as S

ORACLES: dict[str, str] = {}


def ctes(**parts: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({text})" for name, text in parts.items())


def duck(text: str) -> str:
    return B.in_duckdb(text)


def pct(num: str, den: str) -> str:
    return f"(((20000 * CAST({num} AS BIGINT) + ({den})) // nullif(2 * ({den}), 0)) / 100.0)"


def avg(num: str, den: str) -> str:
    """Half away from zero, also for negative sums (``//`` truncates)."""
    return (
        f"(sign({num}) * ((200 * CAST(abs({num}) AS BIGINT) + ({den})) // nullif(2 * ({den}), 0)) / 100.0)"
    )


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


YEAR = "CAST(year(f.flight_date) AS INT) AS year"
MONTH = "CAST(month(f.flight_date) AS INT) AS month"
DONE = "f.cancelled = 0 AND f.diverted = 0"


def _on_time(delay: str) -> str:
    return f"count(*) FILTER (WHERE {DONE} AND f.{delay} < 15)"


RATE_COLUMNS = f"""
    {pct(_on_time("arr_delay_minutes"), "count(*)")} AS on_time_rate_pct,
    {avg("sum(f.dep_delay_minutes)", "count(f.dep_delay_minutes)")} AS avg_dep_delay_minutes,
    {avg("sum(f.arr_delay_minutes)", "count(f.arr_delay_minutes)")} AS avg_arr_delay_minutes,
    {pct("sum(f.cancelled)", "count(f.cancelled)")} AS cancellation_rate_pct,
    {pct("sum(f.diverted)", "count(f.diverted)")} AS diversion_rate_pct,
    count(f.dep_delay_minutes) AS dep_delay_flights,
    {big("sum(f.dep_delay_minutes)")} AS dep_delay_sum_minutes,
    count(f.arr_delay_minutes) AS arr_delay_flights,
    {big("sum(f.arr_delay_minutes)")} AS arr_delay_sum_minutes
"""
CAUSE_COLUMNS = ",\n".join(
    f"{avg(f'sum(coalesce(f.{c}_delay, 0))', 'count(*)')} AS avg_{c}_delay_minutes"
    for c in ("carrier", "weather", "nas", "security", "late_aircraft")
)


def _airport(role: str) -> str:
    return ", ".join(
        f"{role}.{c} AS {role}_{c}" for c in ("airport_code", "airport_name", "city", "state_code", "state")
    )


AIRLINE_KPI = f"""
SELECT {YEAR}, {MONTH}, f.airline_id, a.airline_name, a.airline_code, count(*) AS flights,
    {RATE_COLUMNS}, {CAUSE_COLUMNS}
FROM fact f JOIN dim_airline a ON f.airline_id = a.airline_id
GROUP BY year(f.flight_date), month(f.flight_date), f.airline_id, a.airline_name, a.airline_code
"""
_PLACE = "a.airport_code, a.airport_name, a.city, a.state_code, a.state"
AIRPORT_KPI = f"""
SELECT {YEAR}, {MONTH}, f.origin_airport_id AS airport_id, {_PLACE}, 'DEP' AS operation,
    count(*) AS flights,
    {avg("sum(f.dep_delay_minutes)", "count(f.dep_delay_minutes)")} AS avg_delay_minutes,
    {pct(_on_time("dep_delay_minutes"), "count(*)")} AS on_time_rate_pct,
    {pct("sum(f.cancelled)", "count(f.cancelled)")} AS cancellation_rate_pct,
    {pct("sum(f.diverted)", "count(f.diverted)")} AS diversion_rate_pct,
    count(f.dep_delay_minutes) AS delay_flights,
    {big("sum(f.dep_delay_minutes)")} AS delay_sum_minutes
FROM fact f JOIN dim_airport a ON f.origin_airport_id = a.airport_id
GROUP BY year(f.flight_date), month(f.flight_date), f.origin_airport_id, {_PLACE}
UNION ALL
SELECT {YEAR}, {MONTH}, f.dest_airport_id, {_PLACE}, 'ARR',
    count(*) FILTER (WHERE {DONE}),
    {avg(f"sum(f.arr_delay_minutes) FILTER (WHERE {DONE})", f"count(f.arr_delay_minutes) FILTER (WHERE {DONE})")},
    {pct(_on_time("arr_delay_minutes"), f"count(*) FILTER (WHERE {DONE})")},
    NULL, NULL,
    count(f.arr_delay_minutes) FILTER (WHERE {DONE}),
    {big(f"sum(f.arr_delay_minutes) FILTER (WHERE {DONE})")}
FROM fact f JOIN dim_airport a ON f.dest_airport_id = a.airport_id
GROUP BY year(f.flight_date), month(f.flight_date), f.dest_airport_id, {_PLACE}
"""
ROUTE_KPI = f"""
SELECT {YEAR}, {MONTH}, f.origin_airport_id, f.dest_airport_id, {_airport("origin")}, {_airport("dest")},
    count(*) AS flights, {RATE_COLUMNS}
FROM fact f
JOIN dim_airport origin ON f.origin_airport_id = origin.airport_id
JOIN dim_airport dest ON f.dest_airport_id = dest.airport_id
GROUP BY ALL
"""
FLIGHT_KPI = f"""
SELECT {YEAR}, {MONTH}, f.airline_id, a.airline_name, a.airline_code, f.flight_number,
    f.origin_airport_id, f.dest_airport_id,
    origin.airport_code AS origin_airport_code, origin.city AS origin_city,
    origin.state_code AS origin_state_code, origin.state AS origin_state,
    dest.airport_code AS dest_airport_code, dest.city AS dest_city,
    dest.state_code AS dest_state_code, dest.state AS dest_state,
    count(*) AS flights, {RATE_COLUMNS}
FROM fact f
JOIN dim_airline a ON f.airline_id = a.airline_id
JOIN dim_airport origin ON f.origin_airport_id = origin.airport_id
JOIN dim_airport dest ON f.dest_airport_id = dest.airport_id
GROUP BY ALL
"""

CORE = {"fact": duck(B.AIRLINE_FACT), "dim_airline": duck(B.DIM_AIRLINE)}
FULL = {"fact": duck(B.FACT), "dim_airline": duck(B.DIM_AIRLINE), "dim_airport": duck(B.DIM_AIRPORT)}
WITH_AIRLINES = {**CORE, "kc": AIRLINE_KPI}
WITH_AIRPORTS = {**FULL, "kl": AIRPORT_KPI}
WITH_ROUTES = {**FULL, "kr": ROUTE_KPI}
WITH_FLIGHTS = {**FULL, "ks": FLIGHT_KPI}

ORACLES["carrier_kpi"] = f"{ctes(**CORE)} {AIRLINE_KPI}"
ORACLES["airport_kpi"] = f"{ctes(**FULL)} {AIRPORT_KPI}"
ORACLES["route_kpi"] = f"{ctes(**FULL)} {ROUTE_KPI}"
ORACLES["shipment_kpi"] = f"{ctes(**FULL)} {FLIGHT_KPI}"


# ---- scans and sinks --------------------------------------------------------------------
_TYPED_ORDERS = """
SELECT CAST(o_orderkey AS INT) AS o_orderkey,
    CASE WHEN o_orderkey % 11 = 3 THEN NULL ELSE CAST(o_custkey AS INT) END AS o_custkey,
    CASE WHEN o_orderkey % 13 = 3 THEN NULL ELSE o_totalprice END AS o_totalprice,
    CASE WHEN o_orderkey % 17 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_orderdate,
    upper(o_orderpriority) AS o_orderpriority
FROM orders
"""
ORACLES["scan_csv_typed"] = _TYPED_ORDERS
ORACLES["scan_zipped_csv"] = _TYPED_ORDERS

_BUCKETS = f"SELECT DISTINCT o_orderkey // {B.ORDERS_PER_FILE} AS bucket FROM orders"
ORACLES["profile_files"] = f"""
SELECT 'orders_' || lpad(CAST(bucket AS VARCHAR), 6, '0') || '.csv' AS file_name,
    CASE bucket % 5 WHEN 1 THEN 'empty' WHEN 2 THEN 'missing_columns' WHEN 3 THEN 'no_rows' ELSE 'ok' END
        AS verdict,
    CASE bucket % 5 WHEN 1 THEN '{",".join(B.ORDER_FILE_COLUMNS)}' WHEN 2 THEN 'o_totalprice' ELSE '' END
        AS missing_columns
FROM ({_BUCKETS})
"""
ORACLES["verify_archives"] = f"""
SELECT 'orders_' || lpad(CAST(bucket AS VARCHAR), 6, '0') || '.zip' AS file_name,
    {big("CASE WHEN bucket % 5 IN (1, 2) THEN 0 ELSE 2 END")} AS members,
    CASE bucket % 5 WHEN 1 THEN 'empty' WHEN 2 THEN 'not_zip' WHEN 3 THEN 'corrupt' ELSE 'ok' END AS verdict
FROM ({_BUCKETS})
"""

_YEAR, _MONTH = Q.PERIOD
ORACLES["scan_period"] = f"""
{ctes(fact=duck(B.FACT))}
SELECT *, {_YEAR} AS year, {_MONTH} AS month FROM fact
WHERE year(flight_date) = {_YEAR} AND month(flight_date) = {_MONTH}
"""
_AIRLINE_COLUMNS = ", ".join(S.AIRLINE_KPI.names)
ORACLES["replace_period"] = f"""
{ctes(**WITH_AIRLINES)}
SELECT {_AIRLINE_COLUMNS.replace("flights,", f"CASE WHEN year = {_YEAR} AND month = {_MONTH} THEN 2 * flights ELSE flights END AS flights,", 1)}
FROM kc
WHERE NOT (year = {Q.EMPTIED_PERIOD[0]} AND month = {Q.EMPTIED_PERIOD[1]})
"""
ORACLES["append_rows"] = f"{ctes(**CORE)} {AIRLINE_KPI}"
ORACLES["ensure_table"] = f"{ctes(**CORE)} {AIRLINE_KPI}"


def _null_before_1999(column: str) -> str:
    return f"CASE WHEN year > 1998 THEN {column} END AS {column}"


_ADDED = ["dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes"]
ORACLES["evolve_schema"] = f"""
{ctes(**WITH_AIRLINES)}
SELECT {", ".join(_null_before_1999(c) if c in _ADDED else c for c in S.AIRLINE_KPI.names)} FROM kc
"""
ORACLES["upsert_dim"] = f"""
{ctes(dim=duck(B.DIM_AIRLINE))}
SELECT d.airline_id,
    CASE WHEN s.s_acctbal > 0 THEN d.airline_name ELSE 'old ' || d.airline_name END AS airline_name,
    d.airline_code
FROM dim d JOIN supplier s ON d.airline_id = s.s_suppkey
WHERE s.s_acctbal > 0 OR s.s_acctbal < 5000
"""
ORACLES["upsert_buckets"] = ORACLES["upsert_dim"]
_FACT_KEY = ", ".join(S.FACT_BUSINESS_KEY)
ORACLES["surrogate_key"] = f"""
{ctes(fact=duck(B.FACT))}
SELECT row_number() OVER (ORDER BY {_FACT_KEY}) AS flight_id, {_FACT_KEY}
FROM (SELECT DISTINCT {_FACT_KEY} FROM fact)
"""
_IN_PERIODS = " OR ".join(f"(year = {y} AND month = {m})" for y, m in Q.PERIODS)
_KPI_SOURCES = {"airlines": "kc", "airports": "kl", "routes": "kr", "flights": "ks"}
WITH_KPIS = {**FULL, "kc": AIRLINE_KPI, "kl": AIRPORT_KPI, "kr": ROUTE_KPI, "ks": FLIGHT_KPI}


def _entity(dataset: str, table: str = "k") -> str:
    return " || '/' || ".join(f"CAST({table}.{c} AS VARCHAR)" for c in Q.ENTITY_IDS[dataset])


def _loaded(dataset: str) -> str:
    places = {"airports": ["a.latitude", "a.longitude"],
              "routes": ["o.latitude", "o.longitude", "d.latitude", "d.longitude"]}.get(dataset, [])
    joins = {
        "airports": "LEFT JOIN dim_airport a ON k.airport_id = a.airport_id",
        "routes": "LEFT JOIN dim_airport o ON k.origin_airport_id = o.airport_id "
                  "LEFT JOIN dim_airport d ON k.dest_airport_id = d.airport_id",
    }.get(dataset, "")
    columns = ", ".join(
        f"CAST({places[i] if i < len(places) else 'NULL'} AS DOUBLE) AS place_{i}" for i in range(4))
    return (
        f"SELECT '{dataset}' AS dataset, k.year, k.month, {_entity(dataset)} AS entity, {big('k.flights')} AS flights, "
        f"k.on_time_rate_pct, {columns} FROM {_KPI_SOURCES[dataset]} k {joins} WHERE {_IN_PERIODS}"
    )


ORACLES["load_gold"] = f"{ctes(**WITH_KPIS)} " + " UNION ALL ".join(map(_loaded, _KPI_SOURCES))

# ---- cleaning ---------------------------------------------------------------------------
_PRESENT = ["l_orderkey", "l_shipdate", "l_returnflag"]
ORACLES["require_columns"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {'true' if c in _PRESENT else 'false'} AS present, "
    f"{f'count({c})' if c in _PRESENT else 'count(NULL)'} AS filled_rows FROM lineitem"
    for c in ["l_orderkey", "l_shipdate", "l_returnflag", "l_commitdate", "l_comment"]
)


def _typed(column: str) -> str:
    if column == "FlightDate":
        return "TRY_CAST(FlightDate AS DATE)"
    if column in S.FLIGHT_CODE_COLUMNS:
        return f"upper(trim({column}))"
    if column in S.FLIGHT_TEXT_COLUMNS:
        return f"trim({column})"
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INTEGER)"


_MASK = " + ".join(
    f"CASE WHEN trim({c}) <> '' AND {_typed(c)} IS NULL THEN {big(str(1 << i))} ELSE 0 END"
    for i, c in enumerate(["FlightDate", *S.FLIGHT_INT_COLUMNS])
)
CLEAN = f"""
SELECT {", ".join(f"{_typed(c)} AS {c}" for c in S.FLIGHT_COLUMNS)},
    CAST(period_year AS INT) AS period_year, CAST(period_month AS INT) AS period_month,
    {big(_MASK)} AS malformed_mask
FROM bronze
"""
ORACLES["clean_fact"] = f"{ctes(bronze=duck(B.BRONZE))} {CLEAN}"


def _lookup(code: str, source: str) -> str:
    """Cleaned lookup rows (code, description): the alphabetically first description per code."""
    return f"""
    SELECT code, description FROM (
        SELECT code, description, row_number() OVER (PARTITION BY code ORDER BY description) AS n
        FROM (SELECT {code} AS code, trim(Description) AS description FROM ({duck(source)}))
        WHERE code IS NOT NULL AND description <> ''
    ) WHERE n = 1
    """


_INT_CODE, _TEXT_CODE = "TRY_CAST(CASE WHEN trim(Code) NOT LIKE '%.%' THEN trim(Code) END AS INTEGER)", "upper(trim(Code))"
_LOOKUPS = {
    "airlines": (_INT_CODE, B.LOOKUP_AIRLINES),
    "airports": (_TEXT_CODE, B.LOOKUP_AIRPORTS),
    "airport_ids": (_INT_CODE, B.LOOKUP_AIRPORT_IDS),
}
ORACLES["clean_lookup"] = " UNION ALL ".join(
    f"SELECT '{name}' AS lookup, CAST(code AS VARCHAR) AS code, description FROM ({_lookup(*parts)})"
    for name, parts in _LOOKUPS.items()
)


def _lookup_report(name: str, code: str, source: str) -> str:
    metrics = {
        ("result", "bronze_rows"): "(SELECT count(*) FROM r)",
        ("validation", "missing_code"): "(SELECT count(*) FROM r WHERE code IS NULL)",
        ("validation", "missing_description"):
            "(SELECT count(*) FROM r WHERE description IS NULL OR description = '')",
        ("validation", "duplicate_codes"):
            "(SELECT count(*) FROM (SELECT code FROM r WHERE code IS NOT NULL GROUP BY code HAVING count(*) > 1))",
        ("result", "silver_rows"):
            "(SELECT count(DISTINCT code) FROM r WHERE description <> '')",
    }
    metrics["result", "total_rejected"] = (
        f"{metrics['result', 'bronze_rows']} - {metrics['result', 'silver_rows']}"
    )
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{section}' AS section, '{metric}' AS metric, {big(value)} AS value"
        for (section, metric), value in metrics.items()
    )
    return (
        f"SELECT * FROM (WITH r AS (SELECT {code} AS code, trim(Description) AS description "
        f"FROM ({duck(source)})) {rows})"
    )


ORACLES["lookup_validation"] = " UNION ALL ".join(
    _lookup_report(name, *parts) for name, parts in _LOOKUPS.items()
)

_COORDINATE_ATTRIBUTES = "AirportCode, AirportName, AirportCityName, AirportStateName, Latitude, Longitude"
CLEAN_COORDINATES = f"""
SELECT AirportID, {_COORDINATE_ATTRIBUTES} FROM (
    SELECT *, row_number() OVER (PARTITION BY AirportID ORDER BY {", ".join(
        f"{c} NULLS FIRST" for c in _COORDINATE_ATTRIBUTES.split(", "))}) AS n
    FROM (
        SELECT TRY_CAST(AIRPORT_ID AS INTEGER) AS AirportID, upper(trim(AIRPORT)) AS AirportCode,
            trim(DISPLAY_AIRPORT_NAME) AS AirportName,
            trim(DISPLAY_AIRPORT_CITY_NAME_FULL) AS AirportCityName,
            trim(AIRPORT_STATE_NAME) AS AirportStateName,
            TRY_CAST(LATITUDE AS DOUBLE) AS Latitude, TRY_CAST(LONGITUDE AS DOUBLE) AS Longitude
        FROM ({duck(B.COORDINATES)}) WHERE AIRPORT_IS_LATEST = '1'
    )
    WHERE AirportID IS NOT NULL AND Latitude BETWEEN -90 AND 90 AND Longitude BETWEEN -180 AND 180
) WHERE n = 1
"""
ORACLES["clean_coordinates"] = CLEAN_COORDINATES

_FIRST_NAME = "trim(regexp_extract({0}, '^(.*?):', 1))"
_FIRST_CODE = "upper(regexp_extract({0}, ':\\s*([A-Za-z0-9]+)', 1))"
_LAST_NAME = "trim(regexp_extract({0}, '^(.*):', 1))"
_LAST_CODE = "upper(regexp_extract({0}, ':\\s*([A-Za-z0-9]+)[^:]*$', 1))"
_AIRPORT_NAME = "trim(regexp_extract({0}, '^(.+),\\s*([^:]+):\\s*(.+)$', 3))"
_CITY = "trim(regexp_extract({0}, '^(.*),\\s*([A-Z]{{2}})$', 1))"
_STATE = "trim(regexp_extract({0}, '^(.*),\\s*([A-Z]{{2}})$', 2))"


def _split(kind: str, source: str, first: str, second: str) -> str:
    label = "trim(Description)"
    return (
        f"SELECT '{kind}' AS kind, {label} AS label, {first.format(label)} AS first, "
        f"{second.format(label)} AS second FROM ({source})"
    )


_CITY_LABELS = """
SELECT array_to_string(list_transform(string_split(p_name, ' '),
    lambda w: upper(w[1:1]) || lower(w[2:])), ' ') || ', ' || upper(substr(p_type, 1, 2)) AS Description
FROM part
"""
ORACLES["split_label"] = " UNION ALL ".join([
    _split("name_code", duck(B.LOOKUP_AIRLINES), _FIRST_NAME, _FIRST_CODE),
    _split("name_code_last", duck(B.LOOKUP_AIRLINES), _LAST_NAME, _LAST_CODE),
    _split("airport_name", duck(B.LOOKUP_AIRPORT_IDS), _AIRPORT_NAME, "''"),
    _split("city_state", _CITY_LABELS, _CITY, _STATE),
])

# ---- rules ------------------------------------------------------------------------------
_CODE = "regexp_matches({}, '^[A-Z]{{3}}$')"


def _or_null(column: str, test: str) -> str:
    return f"({column} IS NULL OR {column} {test})"


_HARD = {
    "origin_code": _CODE.format("Origin"),
    "dest_code": _CODE.format("Dest"),
    "route": "(Origin <> Dest OR Cancelled = 1 OR Diverted = 1)",
    "cancelled": "Cancelled IN (0, 1)",
    "diverted": "Diverted IN (0, 1)",
    "partition_date": "(year(FlightDate) = period_year AND month(FlightDate) = period_month)",
    "year": "Year = period_year",
    "month": "Month = period_month",
    "quarter": "Quarter BETWEEN 1 AND 4",
    "day_of_month": "DayofMonth BETWEEN 1 AND 31",
    "day_of_week": "DayOfWeek BETWEEN 1 AND 7",
}
_SOFT = {
    "depdel15": _or_null("DepDel15", "IN (0, 1)"),
    "arrdel15": _or_null("ArrDel15", "IN (0, 1)"),
    "dep_delay_minutes": _or_null("DepDelayMinutes", ">= 0"),
    "arr_delay_minutes": _or_null("ArrDelayMinutes", ">= 0"),
    "taxi_out": _or_null("TaxiOut", ">= 0"),
    "taxi_in": _or_null("TaxiIn", ">= 0"),
    "crs_elapsed_time": _or_null("CRSElapsedTime", ">= 0"),
    "actual_elapsed_time": _or_null("ActualElapsedTime", ">= 0"),
    "air_time": _or_null("AirTime", ">= 0"),
    "distance": _or_null("Distance", "> 0"),
    "carrier_delay": _or_null("CarrierDelay", ">= 0"),
    "weather_delay": _or_null("WeatherDelay", ">= 0"),
    "nas_delay": _or_null("NASDelay", ">= 0"),
    "security_delay": _or_null("SecurityDelay", ">= 0"),
    "late_aircraft_delay": _or_null("LateAircraftDelay", ">= 0"),
}
_MISSING = {
    "FlightDate": "flight_date", "DOT_ID_Reporting_Airline": "airline_id",
    "Flight_Number_Reporting_Airline": "flight_number", "OriginAirportID": "origin_airport_id",
    "Origin": "origin", "DestAirportID": "dest_airport_id", "Dest": "dest",
}
FLAGGED = "SELECT *, " + ", ".join(
    f"{test} AS valid_{name}" for name, test in {**_HARD, **_SOFT}.items()
) + " FROM clean"
_PASSED = "coalesce(" + " AND ".join(
    [f"{c} IS NOT NULL" for c in _MISSING] + [f"valid_{name}" for name in _HARD]
) + ", false)"
RAW = {"bronze": duck(B.BRONZE), "clean": CLEAN, "flagged": FLAGGED}
_KEY = ", ".join(S.FLIGHT_BUSINESS_KEY)
_ALL = ", ".join(S.FLIGHT_COLUMNS)

ORACLES["rule_flags"] = f"""
{ctes(**RAW)}
SELECT period_year, period_month, {_KEY}, {", ".join(f"valid_{n}" for n in {**_HARD, **_SOFT})} FROM flagged
"""
ORACLES["hard_filter"] = f"{ctes(**RAW)} SELECT period_year, period_month, {_ALL} FROM flagged WHERE {_PASSED}"
_REASONS = ", ".join(
    [f"CASE WHEN {c} IS NULL THEN 'missing_{line}' END" for c, line in _MISSING.items()]
    + [
        f"CASE WHEN valid_{n} IS NULL THEN 'unknown_{n}' WHEN NOT valid_{n} THEN 'invalid_{n}' END"
        for n in _HARD
    ]
)
ORACLES["rejected_rows"] = f"""
{ctes(**RAW)}
SELECT period_year, period_month, {_KEY}, concat_ws(',', {_REASONS}) AS reasons
FROM flagged WHERE NOT {_PASSED}
"""
_LEDGER = {
    "bronze_rows": "count(*)",
    "rejected_by_validation": f"count(*) FILTER (WHERE NOT {_PASSED})",
    "valid_rows": f"count(*) FILTER (WHERE {_PASSED})",
    "duplicates_removed": f"count(*) FILTER (WHERE {_PASSED}) - count(DISTINCT ({_KEY})) FILTER (WHERE {_PASSED})",
    "total_rejected": f"count(*) - count(DISTINCT ({_KEY})) FILTER (WHERE {_PASSED})",
    "silver_rows": f"count(DISTINCT ({_KEY})) FILTER (WHERE {_PASSED})",
}
ORACLES["row_ledger"] = f"""
{ctes(**RAW)}
SELECT period_year, period_month, {", ".join(f"{v} AS {n}" for n, v in _LEDGER.items())}
FROM flagged GROUP BY period_year, period_month
"""


def _count_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


_REPORT = (
    [("hard", f"missing_{line}", _count_if(f"{c} IS NULL")) for c, line in _MISSING.items()]
    + [("hard", f"invalid_{n}", _count_if(f"NOT valid_{n}")) for n in _HARD]
    + [("soft", f"invalid_{n}", _count_if(f"NOT valid_{n}")) for n in _SOFT]
    + [("unknown", f"unknown_{n}", _count_if(f"valid_{n} IS NULL")) for n in _HARD]
    + [
        ("malformed", f"malformed_{c}", _count_if(f"(malformed_mask // {1 << i}) % 2 = 1"))
        for i, c in enumerate(["FlightDate", *S.FLIGHT_INT_COLUMNS])
    ]
    + [("result", n, v) for n, v in _LEDGER.items()]
)
ORACLES["validation_report"] = ctes(**RAW) + " UNION ALL ".join(
    f" SELECT period_year, period_month, '{section}' AS section, '{metric}' AS metric, {value} AS value "
    "FROM flagged GROUP BY period_year, period_month"
    for section, metric, value in _REPORT
)


def _first_per(key: list[str], columns: list[str], source: str, where: str = "true") -> str:
    rest = ", ".join(f"{c} NULLS FIRST" for c in columns if c not in key)
    return (
        f"SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} "
        f"ORDER BY {rest}) AS n FROM {source} WHERE {where}) WHERE n = 1"
    )


_FACT_COLUMNS = [
    "flight_date", "airline_id", "flight_number", "day_of_week", "dep_time_block",
    "dep_delay_minutes", "arr_delay_minutes", "cancelled", "diverted",
    "origin_airport_id", "dest_airport_id",
    "carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay",
]
ORACLES["dedup_business_key"] = (
    f"{ctes(fact=duck(B.FACT))} {_first_per(S.FACT_BUSINESS_KEY, _FACT_COLUMNS, 'fact')}"
)
ORACLES["duplicate_keys"] = f"""
{ctes(fact=duck(B.FACT))}
SELECT {_FACT_KEY}, count(*) AS row_count FROM fact GROUP BY {_FACT_KEY} HAVING count(*) > 1
"""

# ---- star schema ------------------------------------------------------------------------
FACT_FROM_FLIGHTS = "SELECT " + ", ".join(f"{source} AS {name}" for name, source in S.FACT_SOURCES.items())
ORACLES["build_fact"] = f"{ctes(bronze=duck(B.BRONZE), clean=CLEAN)} {FACT_FROM_FLIGHTS} FROM clean"


def _dim_airline() -> str:
    label = "description"
    return f"""
    SELECT code AS airline_id, {_FIRST_NAME.format(label)} AS airline_name,
        {_FIRST_CODE.format(label)} AS airline_code
    FROM ({_lookup(*_LOOKUPS["airlines"])}) WHERE {_FIRST_NAME.format(label)} <> ''
    """


def _dim_airport(flights: str) -> str:
    return f"""
    SELECT b.airport_id, b.airport_code, b.city, b.state_code, b.state,
        {_AIRPORT_NAME.format("n.description")} AS airport_name,
        c.Latitude AS latitude, c.Longitude AS longitude
    FROM ({_first_per(["airport_id"], ["airport_id", "airport_code", "city", "state_code", "state"], f'''(
        SELECT OriginAirportID AS airport_id, Origin AS airport_code, {_CITY.format("OriginCityName")} AS city,
            {_STATE.format("OriginCityName")} AS state_code, OriginStateName AS state FROM {flights}
        UNION ALL
        SELECT DestAirportID, Dest, {_CITY.format("DestCityName")}, {_STATE.format("DestCityName")},
            DestStateName FROM {flights})''', "airport_id IS NOT NULL")}) b
    LEFT JOIN ({_lookup(*_LOOKUPS["airport_ids"])}) n ON b.airport_id = n.code
    LEFT JOIN ({CLEAN_COORDINATES}) c ON b.airport_id = c.AirportID
    """


ORACLES["build_dim_carrier"] = _dim_airline()
ORACLES["build_dim_location"] = f"{ctes(bronze=duck(B.BRONZE), clean=CLEAN)} {_dim_airport('clean')}"

# ---- periods ----------------------------------------------------------------------------
ORACLES["month_slice"] = (
    f"SELECT * FROM lineitem WHERE year(l_shipdate) = {_YEAR} AND month(l_shipdate) = {_MONTH}"
)
_LABEL = "CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS label"
ORACLES["period_catalog"] = f"""
{ctes(**WITH_AIRLINES)}
SELECT DISTINCT year, month, {_LABEL},
    year * 100 + month = (SELECT max(year * 100 + month) FROM kc) AS is_default
FROM kc
"""
ORACLES["stored_period_catalog"] = f"""
{ctes(**WITH_AIRLINES, kept=f"SELECT * FROM kc WHERE NOT (year = {Q.PERIOD[0]} AND month = {Q.PERIOD[1]})")}
SELECT DISTINCT year, month, {_LABEL},
    year * 100 + month = (SELECT max(year * 100 + month) FROM kept) AS is_default
FROM kept
"""
ORACLES["period_range"] = f"""
{ctes(**WITH_AIRLINES)}
SELECT DISTINCT year, month, {_LABEL} FROM kc WHERE year * 100 + month >= {_YEAR * 100 + _MONTH}
"""
_TARGET = Q.RUN_DATE.year * 12 + Q.RUN_DATE.month - 3
ORACLES["resolve_period"] = f"""
{ctes(**WITH_AIRLINES)}
SELECT DISTINCT year, month, year * 12 + month - 1 < {_TARGET} AS used_fallback FROM kc
WHERE year * 12 + month - 1 = (
    SELECT max(year * 12 + month - 1) FROM kc
    WHERE year * 12 + month - 1 IN ({_TARGET}, {_TARGET} - 1))
"""


# ---- re-aggregation ---------------------------------------------------------------------
def _mean(column: str) -> str:
    """Flight-weighted mean of a two-decimal column, NULL values left out."""
    return (
        f"CAST(sum(CAST(round({column} * 100) AS BIGINT) * flights) AS DOUBLE) / "
        f"CAST(nullif(sum(flights) FILTER (WHERE {column} IS NOT NULL) * 100, 0) AS DOUBLE)"
    )


def _combined(measures: list[str]) -> str:
    columns, parts = [], []
    for measure in measures:
        if measure in S.DELAY_PARTS:
            total, count = S.DELAY_PARTS[measure]
            parts += [f"{big(f'coalesce(sum({p}), 0)')} AS {p}" for p in (total, count)]
            columns.append(
                f"CAST(coalesce(sum({total}), 0) AS DOUBLE) / CAST(nullif(sum({count}), 0) AS DOUBLE) AS {measure}"
            )
        else:
            columns.append(f"{_mean(measure)} AS {measure}")
    return ", ".join([f"{big('coalesce(sum(flights), 0)')} AS flights", *parts, *columns])


def combine(source: str, group: list[str], measures: list[str], where: str = "true") -> str:
    return (
        f"SELECT {', '.join(group)}, {_combined(measures)} FROM {source} WHERE {where} "
        f"GROUP BY {', '.join(group)}"
    )


AIRLINES = combine("kc", Q.AIRLINE_GROUP, Q.AIRLINE_MEASURES)
ROUTES = combine("kr", Q.ROUTE_GROUP, Q.ROUTE_MEASURES)


def airports(operation: str) -> str:
    return combine("kl", Q.AIRPORT_GROUP, Q.AIRPORT_MEASURES, f"operation = '{operation}'")


ORACLES["aggregate_periods"] = f"{ctes(**WITH_ROUTES)} {ROUTES}"
ORACLES["weighted_average"] = f"{ctes(**WITH_AIRLINES)} SELECT " + ", ".join(
    f"coalesce(CAST(sum({S.DELAY_PARTS[m][0]}) AS DOUBLE) / CAST(nullif(sum({S.DELAY_PARTS[m][1]}), 0) AS DOUBLE), 0) AS {m}"
    if m in S.DELAY_PARTS else f"{_mean(m)} AS {m}"
    for m in Q.AIRLINE_MEASURES
) + " FROM kc"


_SERIAL = "year * 12 + month - 1"
_MONTHS = f"SELECT unnest(range(min({_SERIAL}), max({_SERIAL}) + 1)) AS at FROM kc"
_RANGED = (f"(SELECT kc.*, {big('r.first * 100000 + r.last')} AS range_id "
           f"FROM kc JOIN r ON {_SERIAL} BETWEEN r.first AND r.last)")
ORACLES["range_kpi"] = (
    ctes(**WITH_AIRLINES, m=_MONTHS, r='SELECT a.at AS "first", b.at AS "last" FROM m a JOIN m b ON a.at <= b.at')
    + " " + combine(_RANGED.replace("r.first", 'r."first"').replace("r.last", 'r."last"'), ["range_id", *Q.AIRLINE_GROUP], Q.AIRLINE_MEASURES)
)


def millionths(value: str) -> str:
    return f"sum(CAST({value} AS DECIMAL(38, 6)))"


def exact(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE))"


def _total(source: str, labels: dict, columns: list[str], measures: list[str], keep: bool) -> str:
    """The total row in the column order of the entity rows."""
    out = []
    for column in columns:
        if column in labels:
            value = labels[column]
            out.append(f"{'NULL' if value is None else repr(value)} AS {column}")
        elif column in measures and column in S.DELAY_PARTS:
            total, count = S.DELAY_PARTS[column]
            out.append(f"coalesce({exact(f'sum({total})', f'sum({count})')}, 0) AS {column}")
        elif column in measures:
            kept = f"FILTER (WHERE {column} IS NOT NULL)" if not keep else ""
            rate = exact(millionths(f"{column} * flights"), f"sum(flights) {kept}")
            out.append(f"{f'coalesce({rate}, 0)' if keep else rate} AS {column}")
        elif column == "flights" or column.endswith(("_flights", "_sum_minutes")):
            out.append(f"{big(f'coalesce(sum({column}), 0)')} AS {column}")
        else:
            out.append(f"NULL AS {column}")
    return f"SELECT {', '.join(out)} FROM {source}"


def _entity_columns(group: list[str], measures: list[str]) -> list[str]:
    parts = [p for m in measures for p in S.DELAY_PARTS.get(m, ())]
    return [*group, "flights", *parts, *measures]


_columns = _entity_columns(Q.AIRLINE_GROUP, Q.AIRLINE_MEASURES)
ORACLES["carrier_totals"] = f"""
{ctes(**WITH_AIRLINES, e=AIRLINES)}
SELECT {", ".join(_columns)}, false AS is_total FROM e
UNION ALL SELECT *, true FROM ({_total("e", Q.AIRLINE_TOTAL, _columns, Q.AIRLINE_MEASURES, False)})
"""
_columns = _entity_columns(Q.AIRPORT_GROUP, Q.AIRPORT_MEASURES)
ORACLES["airport_totals"] = ctes(**WITH_AIRPORTS, dep=airports("DEP"), arr=airports("ARR")) + " UNION ALL ".join(
    f" SELECT {', '.join(_columns)}, false AS is_total, '{op}' AS operation FROM {op} "
    f"UNION ALL SELECT *, true, '{op}' FROM ({_total(op, Q.AIRPORT_TOTAL, _columns, Q.AIRPORT_MEASURES, True)})"
    for op in ("DEP", "ARR")
)
_columns = _entity_columns(Q.ROUTE_GROUP, Q.ROUTE_MEASURES) + ["route"]
ORACLES["route_totals"] = f"""
{ctes(**WITH_ROUTES, e=f"SELECT *, origin_airport_code || ' → ' || dest_airport_code AS route FROM ({ROUTES})")}
SELECT {", ".join(_columns)}, false AS is_total FROM e
UNION ALL SELECT *, true FROM ({_total("e", Q.ROUTE_TOTAL, _columns, Q.ROUTE_MEASURES, True)})
"""
ORACLES["select_entities"] = f"""
{ctes(**WITH_AIRLINES, e=AIRLINES)}
SELECT * FROM e WHERE airline_name IN (SELECT s_name FROM supplier WHERE s_acctbal > 5000)
"""
ORACLES["min_share"] = f"""
{ctes(**WITH_ROUTES, e=ROUTES)}
SELECT * FROM e WHERE flights > (SELECT sum(flights) * CAST(0.002 AS DOUBLE) FROM e)
"""
ORACLES["min_volume"] = f"{ctes(**WITH_ROUTES, e=ROUTES)} SELECT * FROM e WHERE flights > {Q.MONTHS}"
ORACLES["route_pick"] = f"{ctes(**WITH_ROUTES, e=ROUTES)} SELECT * FROM e WHERE origin_airport_code = 'NCX'"
ORACLES["route_options"] = f"{ctes(**WITH_ROUTES)}" + " UNION ALL ".join(
    f" SELECT DISTINCT '{r}' AS role, {r}_airport_code AS airport_code, {r}_airport_name AS airport_name, "
    f"{r}_city AS city, {r}_state_code AS state_code FROM kr"
    for r in ("origin", "dest")
)
ORACLES["entity_counts"] = f"{ctes(**WITH_FLIGHTS)} SELECT count(*) AS row_count, " + ", ".join(
    f"count(DISTINCT {c}) AS {c}_count"
    for c in ["airline_id", "flight_number", "origin_airport_id", "dest_airport_id"]
) + " FROM ks"
_FLIGHT_GROUP = [
    "airline_id", "airline_name", "airline_code", "flight_number", "origin_airport_id", "dest_airport_id",
]
_VIEW = f"""
SELECT airline_name, count(DISTINCT flight_number) AS flight_numbers, {big("sum(flights)")} AS flights,
    {exact(millionths("on_time_rate_pct * flights"), "sum(flights)")} AS overall_on_time_rate
FROM e GROUP BY airline_name
"""
ORACLES["shipment_view"] = f"""
{ctes(**WITH_FLIGHTS, e=combine("ks", _FLIGHT_GROUP, ["on_time_rate_pct"]), v=_VIEW)}
SELECT *, false AS picked FROM v UNION ALL SELECT *, true FROM v WHERE airline_name = '{Q.AIRLINE_PICK}'
"""


# ---- ranking ----------------------------------------------------------------------------
def _top(source: str, order: str, n: int) -> str:
    return (
        f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INT) AS position FROM {source} "
        f"QUALIFY row_number() OVER (ORDER BY {order}) <= {n}"
    )


ORACLES["top_routes"] = ctes(**WITH_ROUTES, e=ROUTES) + _top(
    "e", "avg_arr_delay_minutes DESC NULLS LAST, origin_airport_id, dest_airport_id", 20
)
ORACLES["top_airports"] = ctes(**WITH_AIRPORTS, e=airports("DEP")) + _top(
    "e", "avg_delay_minutes DESC NULLS LAST, airport_id", 20
)
_ROUTE_NAME = "origin_airport_code || ' → ' || dest_airport_code"
_SORTS = {
    "airport_city": ("dep", "airport_code", "city NULLS LAST, airport_code, airport_id"),
    "airport_flights": ("dep", "airport_code", "flights DESC, city NULLS LAST, airport_code, airport_id"),
    "airport_code": ("dep", "airport_code", "airport_code, airport_id"),
    "airport_state": ("dep", "airport_code", "state, city NULLS LAST, airport_code, airport_id"),
    "route_flights": (
        "e", _ROUTE_NAME,
        "flights DESC, origin_airport_code, dest_airport_code, origin_airport_id, dest_airport_id",
    ),
    "route_alphabetical": (
        "e", _ROUTE_NAME,
        "origin_city NULLS LAST, origin_airport_code, dest_city NULLS LAST, dest_airport_code, "
        "origin_airport_id, dest_airport_id",
    ),
}
ORACLES["entity_sort"] = ctes(
    **FULL, kl=AIRPORT_KPI, kr=ROUTE_KPI, dep=airports("DEP"), e=ROUTES
) + " UNION ALL ".join(
    f" SELECT '{mode}' AS mode, row_number() OVER (ORDER BY {order}) AS position, {entity} AS entity FROM {source}"
    for mode, (source, entity, order) in _SORTS.items()
)
_NAMED = "SELECT airline_id, airline_name, flights, on_time_rate_pct, avg_dep_delay_minutes"
_ALL_AIRLINES = """
SELECT NULL AS airline_id, 'All Airlines' AS airline_name, sum(flights) AS flights,
    sum(on_time_rate_pct * flights) / sum(flights) AS on_time_rate_pct,
    sum(dep_delay_sum_minutes) / sum(dep_delay_flights) AS avg_dep_delay_minutes FROM e
"""
ORACLES["rank_with_total"] = f"""
{ctes(**WITH_AIRLINES, e=AIRLINES, t=_ALL_AIRLINES)}
SELECT 'ranked' AS placement, row_number() OVER (ORDER BY on_time_rate_pct DESC NULLS LAST, airline_name, airline_id) AS position,
    airline_name, {big("flights")} AS flights FROM ({_NAMED} FROM e UNION ALL SELECT * FROM t)
UNION ALL
SELECT 'first', 1 + row_number() OVER (ORDER BY avg_dep_delay_minutes DESC NULLS LAST, airline_name, airline_id),
    airline_name, {big("flights")} FROM e
UNION ALL SELECT 'first', 1, airline_name, {big("flights")} FROM t
UNION ALL
SELECT 'both_ends', 1 + row_number() OVER (ORDER BY airline_name, airline_id), airline_name, {big("flights")} FROM e
UNION ALL SELECT 'both_ends', 1, airline_name, {big("flights")} FROM t
UNION ALL SELECT 'both_ends', (SELECT count(*) + 2 FROM e), airline_name, {big("flights")} FROM t
UNION ALL
SELECT 'omitted', row_number() OVER (ORDER BY flights DESC, airline_name, airline_id), airline_name, {big("flights")} FROM e
"""

# ---- series and maps --------------------------------------------------------------------


def _trend(source: str, entity: str, measures: list[str], label: str, where: str = "true", also: str = "") -> str:
    """Series of all entities and of each, one row per metric; ``source`` is a table of the WITH part."""
    both = f"cancellation_rate_pct + diversion_rate_pct AS cancel_diversion_rate_pct"
    columns = ", ".join(measures)
    rows = (
        f"SELECT year, month, '{label}' AS {entity}, true AS is_total, flights, {columns}, {both} "
        f"FROM ({combine(source, ['year', 'month'], measures, where)}) "
        f"UNION ALL SELECT year, month, {entity}, false, {big('flights')}, {columns}, {both} FROM {source} WHERE {where}"
    )
    return " UNION ALL ".join(
        f"SELECT make_date(year, month, 1) AS period, {entity}, is_total, flights, '{m}' AS metric, {m} AS value{also} FROM ({rows})"
        for m in [*measures, "cancel_diversion_rate_pct"]
    )


ORACLES["kpi_trend"] = f"{ctes(**WITH_AIRLINES)} {_trend('kc', 'airline_name', Q.AIRLINE_MEASURES, 'All Airlines')}"
ORACLES["airport_trend"] = f"{ctes(**WITH_AIRPORTS)} " + " UNION ALL ".join(
    _trend("kl", "airport_code", Q.AIRPORT_MEASURES, "All Airports", f"operation = '{op}'", f", '{op}' AS operation")
    for op in ("DEP", "ARR")
)
ORACLES["route_trend"] = (
    f"{ctes(**WITH_ROUTES, named=f'SELECT *, {_ROUTE_NAME} AS route FROM kr')} "
    f"{_trend('named', 'route', Q.ROUTE_MEASURES, 'All Routes')}"
)
_DEST = "CASE WHEN dest_airport_id <> 7 THEN dest_airport_code END"
ORACLES["route_labels"] = f"""
{ctes(**WITH_ROUTES)}
SELECT DISTINCT origin_airport_id, dest_airport_id,
    origin_airport_code || ' → ' || {_DEST} AS route,
    coalesce(origin_city, '') || ' (' || coalesce(origin_airport_code, '') || ') → ' ||
        coalesce(dest_city, '') || ' (' || coalesce({_DEST}, '') || ')' AS display_route,
    coalesce(dest_city, '') || ' (' || {_DEST} || ')' AS display_dest
FROM kr
"""


def _band(column: str, good: str, middle: str) -> str:
    return f"CASE WHEN {column} {good} THEN 'green' WHEN {column} {middle} THEN 'gold' ELSE 'red' END"


ORACLES["reliability_band"] = f"""
{ctes(**WITH_AIRPORTS)}
SELECT year, month, operation, airport_id,
    {_band("on_time_rate_pct", ">= 80", ">= 70")} AS on_time_band,
    {_band("avg_delay_minutes", "<= 15", "<= 25")} AS delay_band,
    {_band("cancellation_rate_pct", "<= 1", "<= 3")} AS cancellation_band,
    {_band("diversion_rate_pct", "<= 0.5", "<= 1")} AS diversion_band
FROM kl
"""
_PLACED_ROUTES = f"""
SELECT e.*, o.latitude AS origin_latitude, o.longitude AS origin_longitude,
    d.latitude AS dest_latitude, d.longitude AS dest_longitude
FROM ({ROUTES}) e
JOIN dim_airport o ON e.origin_airport_id = o.airport_id
JOIN dim_airport d ON e.dest_airport_id = d.airport_id
WHERE o.latitude IS NOT NULL AND d.latitude IS NOT NULL
"""
ORACLES["scale_size"] = f"""
{ctes(**FULL, kl=AIRPORT_KPI, kr=ROUTE_KPI, r=_PLACED_ROUTES,
      a=f"SELECT e.* FROM ({airports('ARR')}) e JOIN dim_airport d USING (airport_id) WHERE d.latitude IS NOT NULL")}
SELECT 'airport' AS kind, airport_code AS entity, flights,
    CASE WHEN (SELECT max(flights) FROM a) > 0
         THEN CAST(flights AS DOUBLE) / (SELECT max(flights) FROM a) * 30 + 8 ELSE 8 END AS size
FROM a
UNION ALL
SELECT 'route', {_ROUTE_NAME}, flights,
    CASE WHEN (SELECT max(flights) = min(flights) FROM r) THEN 3.0
         ELSE 1.0 + (sqrt(flights) - (SELECT sqrt(min(flights)) FROM r))
              / (SELECT sqrt(max(flights)) - sqrt(min(flights)) FROM r) * 3.0 END
FROM r
"""
ORACLES["geo_points"] = f"""
{ctes(**WITH_ROUTES, r=_PLACED_ROUTES)}
SELECT code, name, lat, lon FROM (
    SELECT *, row_number() OVER (PARTITION BY code ORDER BY flights, o, d, place DESC) AS n
    FROM (
        SELECT origin_airport_code AS code, origin_airport_name AS name, origin_latitude AS lat,
            origin_longitude AS lon, flights, origin_airport_code AS o, dest_airport_code AS d, 0 AS place FROM r
        UNION ALL
        SELECT dest_airport_code, dest_airport_name, dest_latitude, dest_longitude, flights,
            origin_airport_code, dest_airport_code, 1 FROM r
    )
) WHERE n = 1
"""

# ---- quality ----------------------------------------------------------------------------
QUALITY = {
    **FULL, "dim_airline": duck(B.DIM_AIRLINE_PARTIAL),
    "kc": AIRLINE_KPI, "kl": AIRPORT_KPI, "kr": ROUTE_KPI, "ks": FLIGHT_KPI,
    "f": "SELECT *, CAST(year(flight_date) AS INT) AS year, CAST(month(flight_date) AS INT) AS month FROM fact",
    "p": "SELECT DISTINCT year, month FROM f",
}
_IN = "year = p.year AND month = p.month"


def _orphans(key: str, dim: str, primary: str) -> str:
    return (
        f"SELECT count(*) FROM f LEFT JOIN {dim} d ON f.{key} = d.{primary} "
        f"WHERE f.year = p.year AND f.month = p.month AND d.{primary} IS NULL"
    )


def _bad_kpis(table: str) -> str:
    return (
        f"SELECT count(*) FROM {table} WHERE {_IN} AND (flights < 0 OR on_time_rate_pct NOT BETWEEN 0 AND 100 "
        "OR cancellation_rate_pct NOT BETWEEN 0 AND 100 OR diversion_rate_pct NOT BETWEEN 0 AND 100)"
    )


_CHECKS = {
    "invalid_required_fields":
        f"SELECT count(*) FROM f WHERE {_IN} AND ({' OR '.join(f'{c} IS NULL' for c in S.FACT_REQUIRED)})",
    "invalid_flags":
        f"SELECT count(*) FROM f WHERE {_IN} AND (cancelled NOT IN (0, 1) OR diverted NOT IN (0, 1))",
    "unknown_airlines": _orphans("airline_id", "dim_airline", "airline_id"),
    "unknown_origin_airports": _orphans("origin_airport_id", "dim_airport", "airport_id"),
    "unknown_dest_airports": _orphans("dest_airport_id", "dim_airport", "airport_id"),
    "duplicate_flights":
        f"SELECT count(*) FROM (SELECT 1 FROM f WHERE {_IN} GROUP BY {_FACT_KEY} HAVING count(*) > 1)",
    "invalid_airline_kpis": _bad_kpis("kc"),
    "invalid_airport_kpis": _bad_kpis("kl"),
    "invalid_route_kpis": _bad_kpis("kr"),
    "fact_vs_airline_gold":
        f"SELECT abs((SELECT count(*) FROM f WHERE {_IN}) - "
        f"(SELECT coalesce(sum(flights), 0) FROM kc WHERE {_IN}))",
}
_SUITE = " UNION ALL ".join(
    f"SELECT p.year, p.month, '{name}' AS check_name, {i} AS place, CAST(({sql}) AS BIGINT) AS error_count FROM p"
    for i, (name, sql) in enumerate(_CHECKS.items())
)
ORACLES["dq_suite"] = f"{ctes(**QUALITY)} SELECT year, month, check_name, error_count FROM ({_SUITE})"
ORACLES["quality_gate"] = f"""
{ctes(**QUALITY, suite=_SUITE)}
SELECT year, month, count(*) FILTER (WHERE error_count <> 0) AS failed_checks,
    arg_min(check_name, place) FILTER (WHERE error_count <> 0) AS first_failure,
    count(*) FILTER (WHERE error_count <> 0) = 0 AS passed
FROM suite GROUP BY year, month
"""
_TABLES = {"fact_flight": "f", **{S.KPI_TABLES[d]: t for d, t in
           {"airlines": "kc", "airports": "kl", "routes": "kr", "flights": "ks"}.items()}}
ORACLES["presence_check"] = f"{ctes(**QUALITY)} SELECT *, row_count > 0 AS present FROM (" + " UNION ALL ".join(
    f"SELECT p.year, p.month, '{name}' AS table_name, (SELECT count(*) FROM {t} WHERE {_IN}) AS row_count FROM p"
    for name, t in _TABLES.items()
) + ")"



def _of_fact(ids: list[str]) -> str:
    columns = ", ".join(f"f.{i}" for i in ids)
    return f"SELECT {YEAR}, {MONTH}, {columns}, count(*) AS flights, {RATE_COLUMNS} FROM fact f GROUP BY ALL"


def _planted(dataset: str, columns: list[str]) -> str:
    """The columns of a KPI table with the differences that the query sets into it."""
    out = {c: c for c in columns}
    for table, column, by, where in Q.PLANTED:
        if table == dataset:
            out[column] = f"CASE WHEN {where} THEN {out[column]} + {by} ELSE {out[column]} END"
    gap = f"WHERE NOT ({Q.PLANTED_GAP})" if dataset == "routes" else ""
    return f"SELECT year, month, {', '.join(f'{v} AS {c}' for c, v in out.items())} FROM {_KPI_SOURCES[dataset]} {gap}"


_FACT_ENDS = re.sub(r", a\.[a-z_]+|JOIN dim_airport a ON f\.[a-z_]+ = a\.[a-z_]+", "", AIRPORT_KPI)
_CHECKED_RATES = ["on_time_rate_pct", "cancellation_rate_pct", "diversion_rate_pct"]
_CHECKED = ["flights", "dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes", *_CHECKED_RATES]
_CHECKED_ENDS = ["airport_id", "operation", "flights", "delay_flights", "delay_sum_minutes", *_CHECKED_RATES]
_CHECKSUM_SIDES = {
    "airline_checksum": ("airlines", ["airline_id", *_CHECKED], _of_fact(["airline_id"]), "true"),
    "departure_checksum": ("airports", _CHECKED_ENDS, _FACT_ENDS, "operation = 'DEP'"),
    "arrival_checksum": ("airports", _CHECKED_ENDS, _FACT_ENDS, "operation = 'ARR'"),
    "route_checksum": ("routes", ["origin_airport_id", "dest_airport_id", *_CHECKED], _of_fact(["origin_airport_id", "dest_airport_id"]), "true"),
    "flight_checksum": ("flights", [*Q.ENTITY_IDS["flights"], *_CHECKED], _of_fact(Q.ENTITY_IDS["flights"]), "true"),
}


def _checksum(check: str, dataset: str, columns: list[str], fact: str, where: str) -> str:
    listed = ", ".join(columns)
    return (
        f"SELECT year, month, '{check}' AS check_name, {big("CASE WHEN bool_and(n = 0) THEN 0 ELSE greatest(1, abs(sum(n * flights))) END")} "
        f"AS error_count FROM (SELECT year, month, {listed}, sum(side) AS n FROM (SELECT year, month, {listed}, 1 AS side FROM ({fact}) "
        f"UNION ALL SELECT year, month, {listed}, -1 FROM ({_planted(dataset, columns)})) WHERE {where} GROUP BY year, month, {listed}) "
        "WHERE year IS NOT NULL GROUP BY year, month"
    )


ORACLES["gold_checksums"] = f"{ctes(**WITH_KPIS)} " + " UNION ALL ".join(
    _checksum(check, *sides) for check, sides in _CHECKSUM_SIDES.items())

# ---- whole jobs -------------------------------------------------------------------------
_SILVER_SOURCE = _first_per(
    S.FLIGHT_BUSINESS_KEY, [*S.FLIGHT_COLUMNS, "period_year", "period_month"], "flagged", _PASSED
)
_SILVER_COLUMNS = ", ".join(c for c in S.FLIGHT_COLUMNS if c not in ("Year", "Month"))
ORACLES["silver_build"] = f"""
{ctes(**RAW)}
SELECT {_SILVER_COLUMNS}, period_year AS year, period_month AS month FROM ({_SILVER_SOURCE})
"""
ORACLES["lookup_build"] = ORACLES["clean_lookup"] + (
    " UNION ALL SELECT 'airport_coordinates', CAST(AirportID AS VARCHAR), AirportName "
    f"FROM ({CLEAN_COORDINATES})"
)
_MONTHS_BUILT = {
    **RAW, "silver": _SILVER_SOURCE, "fact": f"{FACT_FROM_FLIGHTS} FROM silver", "dim_airline": _dim_airline(),
    "dim_airport": _dim_airport("silver"),
    "kc": AIRLINE_KPI, "kl": AIRPORT_KPI, "kr": ROUTE_KPI, "ks": FLIGHT_KPI,
}
ORACLES["month_build"] = f"{ctes(**_MONTHS_BUILT)} " + " UNION ALL ".join(
    f"SELECT '{d}' AS dataset, k.year, k.month, {_entity(d)} AS entity, {big('k.flights')} AS flights, k.on_time_rate_pct "
    f"FROM {t} k" for d, t in _KPI_SOURCES.items()
)
_OLD = {f"old_{t}": text.replace("FROM fact f", "FROM fact_old f") for t, text in (
    ("kc", AIRLINE_KPI), ("kl", AIRPORT_KPI), ("kr", ROUTE_KPI), ("ks", FLIGHT_KPI))}
_IN_PERIOD = f"year = {Q.PERIOD[0]} AND month = {Q.PERIOD[1]}"


def _seen(phase: str, dataset: str, source: str) -> str:
    return (f"SELECT '{phase}' AS phase, '{dataset}' AS dataset, year, month, count(*) AS row_count, {big('sum(flights)')} AS flights "
            f"FROM {source} GROUP BY year, month")


ORACLES["publish_month"] = (
    ctes(**{**WITH_KPIS, "fact_old": "SELECT * FROM fact WHERE airline_id % 2 = 0", **_OLD}) + " UNION ALL ".join(
        " " + _seen(phase, dataset, source) for dataset, t in _KPI_SOURCES.items() for phase, source in (
            ("before", f"old_{t}"), ("failed", f"old_{t}"),
            ("published", f"(SELECT year, month, flights FROM old_{t} WHERE NOT ({_IN_PERIOD}) "
                          f"UNION ALL SELECT year, month, flights FROM {t} WHERE {_IN_PERIOD})")))
)
ORACLES["month_checks"] = (
    f"{ctes(**_MONTHS_BUILT, f=QUALITY['f'], p=QUALITY['p'])} "
    f"SELECT year, month, check_name, error_count FROM ({_SUITE})"
)

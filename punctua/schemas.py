"""Column names, types and table layouts of the data model.

Names, column orders, labels and thresholds in this file are fixed values: they are the
public contract of the files and tables, so they are stated as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- raw flight files -------------------------------------------------------------------
# The columns a raw monthly file must contain, in file order.
FLIGHT_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    "DOT_ID_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "Origin", "OriginCityName", "OriginStateName",
    "DestAirportID", "Dest", "DestCityName", "DestStateName",
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15",
    "DepartureDelayGroups", "DepTimeBlk", "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn",
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15",
    "ArrivalDelayGroups", "ArrTimeBlk", "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]
FLIGHT_DATE_COLUMNS = ["FlightDate"]
FLIGHT_CODE_COLUMNS = ["Origin", "Dest", "CancellationCode"]
FLIGHT_TEXT_COLUMNS = [
    "OriginCityName", "OriginStateName", "DestCityName", "DestStateName",
    "DepTimeBlk", "ArrTimeBlk",
]
FLIGHT_INT_COLUMNS = [
    c for c in FLIGHT_COLUMNS
    if c not in FLIGHT_DATE_COLUMNS + FLIGHT_CODE_COLUMNS + FLIGHT_TEXT_COLUMNS
]

# One flight is identified by these five columns.
FLIGHT_BUSINESS_KEY = [
    "FlightDate", "DOT_ID_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Origin", "Dest",
]

# ---- lookup and coordinate files --------------------------------------------------------
# Columns of the lookup files.
LOOKUP_COLUMNS = ["Code", "Description"]

# Lookup files, how their code is typed, and the names of the cleaned columns.
LOOKUPS = {
    "airlines": {"code_type": "integer", "code_name": "AirlineID", "description_name": "AirlineName"},
    "airports": {"code_type": "string", "code_name": "AirportCode", "description_name": "AirportName"},
    "airport_ids": {"code_type": "integer", "code_name": "AirportID", "description_name": "AirportName"},
}

# Columns of the coordinate file that are used.
COORDINATE_COLUMNS = [
    "AIRPORT_ID", "AIRPORT", "DISPLAY_AIRPORT_NAME", "DISPLAY_AIRPORT_CITY_NAME_FULL",
    "AIRPORT_STATE_NAME", "LATITUDE", "LONGITUDE", "AIRPORT_IS_LATEST",
]

# ---- star schema ------------------------------------------------------------------------
# Columns of the star schema, in table order.
DIM_AIRLINE = T.StructType([
    T.StructField("airline_id", T.IntegerType(), False),
    T.StructField("airline_name", T.StringType(), False),
    T.StructField("airline_code", T.StringType()),
])

DIM_AIRPORT = T.StructType([
    T.StructField("airport_id", T.IntegerType(), False),
    T.StructField("airport_code", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state_code", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("airport_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

# Fact column -> column of the cleaned flight rows.
FACT_SOURCES = {
    "flight_date": "FlightDate",
    "airline_id": "DOT_ID_Reporting_Airline",
    "flight_number": "Flight_Number_Reporting_Airline",
    "origin_airport_id": "OriginAirportID",
    "dest_airport_id": "DestAirportID",
    "day_of_week": "DayOfWeek",
    "dep_time_block": "DepTimeBlk",
    "dep_delay_minutes": "DepDelayMinutes",
    "arr_delay_minutes": "ArrDelayMinutes",
    "cancelled": "Cancelled",
    "diverted": "Diverted",
    "carrier_delay": "CarrierDelay",
    "weather_delay": "WeatherDelay",
    "nas_delay": "NASDelay",
    "security_delay": "SecurityDelay",
    "late_aircraft_delay": "LateAircraftDelay",
}
FACT_FLIGHT = T.StructType([
    T.StructField("flight_id", T.LongType(), False),
    T.StructField("flight_date", T.DateType(), False),
    *[T.StructField(c, T.IntegerType(), False) for c in
      ("airline_id", "flight_number", "origin_airport_id", "dest_airport_id")],
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("dep_time_block", T.StringType()),
    T.StructField("dep_delay_minutes", T.IntegerType()),
    T.StructField("arr_delay_minutes", T.IntegerType()),
    T.StructField("cancelled", T.IntegerType(), False),
    T.StructField("diverted", T.IntegerType(), False),
    *[T.StructField(f"{c}_delay", T.IntegerType()) for c in
      ("carrier", "weather", "nas", "security", "late_aircraft")],
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])
FACT_BUSINESS_KEY = [
    "flight_date", "airline_id", "flight_number", "origin_airport_id", "dest_airport_id",
]
FACT_REQUIRED = FACT_BUSINESS_KEY + ["cancelled", "diverted"]

# ---- KPI tables -------------------------------------------------------------------------
_TEXT_COLUMNS = {
    "airline_name", "airline_code", "operation",
    *(p + c for p in ("", "origin_", "dest_") for c in
      ("airport_code", "airport_name", "city", "state_code", "state")),
}


def _kpi_schema(columns: list[str]) -> T.StructType:
    def kind(name: str) -> T.DataType:
        if name in _TEXT_COLUMNS:
            return T.StringType()
        if name in ("year", "month", "flight_number") or name.endswith("_id"):
            return T.IntegerType()
        if name.endswith("flights") or name.endswith("_sum_minutes"):
            return T.LongType()
        return T.DoubleType()

    return T.StructType([T.StructField(c, kind(c)) for c in columns])


# The columns of the four monthly KPI tables, in table order.
AIRLINE_KPI = _kpi_schema([
    "year", "month", "airline_id", "airline_name", "airline_code", "flights",
    "on_time_rate_pct", "avg_dep_delay_minutes", "avg_arr_delay_minutes",
    "cancellation_rate_pct", "diversion_rate_pct",
    "avg_carrier_delay_minutes", "avg_weather_delay_minutes", "avg_nas_delay_minutes",
    "avg_security_delay_minutes", "avg_late_aircraft_delay_minutes",
    "dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes",
])
AIRPORT_KPI = _kpi_schema([
    "year", "month", "airport_id", "airport_code", "airport_name", "city", "state_code",
    "state", "operation", "flights", "avg_delay_minutes", "on_time_rate_pct",
    "cancellation_rate_pct", "diversion_rate_pct", "delay_flights", "delay_sum_minutes",
])
ROUTE_KPI = _kpi_schema([
    "year", "month",
    "origin_airport_id", "origin_airport_code", "origin_city", "origin_state_code", "origin_state",
    "dest_airport_id", "dest_airport_code", "dest_city", "dest_state_code", "dest_state",
    "flights", "avg_dep_delay_minutes", "avg_arr_delay_minutes", "on_time_rate_pct",
    "cancellation_rate_pct", "diversion_rate_pct",
    "dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes",
    "origin_airport_name", "dest_airport_name",
])
FLIGHT_KPI = _kpi_schema([
    "year", "month", "airline_id", "airline_name", "airline_code", "flight_number",
    "origin_airport_id", "origin_airport_code", "origin_city", "origin_state_code", "origin_state",
    "dest_airport_id", "dest_airport_code", "dest_city", "dest_state_code", "dest_state",
    "flights", "avg_dep_delay_minutes", "avg_arr_delay_minutes", "on_time_rate_pct",
    "cancellation_rate_pct", "diversion_rate_pct",
    "dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes",
])

# Dataset name -> KPI table name.
KPI_TABLES = {
    "airlines": "gold_airline_reliability",
    "airports": "gold_airport_reliability",
    "routes": "gold_route_reliability",
    "flights": "gold_flight_reliability",
}
KPI_SCHEMAS = {
    "airlines": AIRLINE_KPI,
    "airports": AIRPORT_KPI,
    "routes": ROUTE_KPI,
    "flights": FLIGHT_KPI,
}

# Average column -> the (sum, count) columns that combine it exactly.
DELAY_PARTS = {
    "avg_dep_delay_minutes": ("dep_delay_sum_minutes", "dep_delay_flights"),
    "avg_arr_delay_minutes": ("arr_delay_sum_minutes", "arr_delay_flights"),
    "avg_delay_minutes": ("delay_sum_minutes", "delay_flights"),
}

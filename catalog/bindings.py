"""Inputs of the registered queries, derived from the given tables.

Each input is one SELECT in the SQL that Spark and DuckDB share, so a query and its SQL
counterpart start from the same rows; everything after it is written twice, independently.
``{name}`` stands for a table. Line items play the flights: suppliers are the airlines, nations
the airports, line numbers the flight numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

_MEASURES = """
    CAST(l.l_shipdate AS DATE) AS flight_date,
    CAST(l.l_suppkey AS INT) AS airline_id,
    l.l_linenumber AS flight_number,
    CAST(l.l_orderkey % 7 + 1 AS INT) AS day_of_week,
    CASE WHEN l.l_partkey % 2 = 0 THEN '0600-0659' ELSE '1700-1759' END AS dep_time_block,
    CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(l.l_quantity AS INT) - 1 END AS dep_delay_minutes,
    CASE WHEN l.l_returnflag = 'R' OR l.l_linenumber = 7 THEN NULL
         ELSE CAST(round(l.l_discount * 100) AS INT) * 5 END AS arr_delay_minutes,
    CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS cancelled,
    CASE WHEN l.l_returnflag <> 'R' AND l.l_linenumber = 7 THEN 1 ELSE 0 END AS diverted
"""
_CAUSES = """
    CASE WHEN arr_delay_minutes >= 15 THEN tax END AS carrier_delay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(okey % 11 AS INT) END AS weather_delay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(pkey % 13 AS INT) END AS nas_delay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(airline_id % 3 AS INT) END AS security_delay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(okey % 17 AS INT) END AS late_aircraft_delay
"""
_EXTRA = """
    CAST(round(l.l_tax * 100) AS INT) AS tax, l.l_orderkey AS okey, l.l_partkey AS pkey
"""
_FACT_COLUMNS = """flight_date, airline_id, flight_number, day_of_week, dep_time_block,
    dep_delay_minutes, arr_delay_minutes, cancelled, diverted"""

# The fact without its airports: what the airline KPI needs, with no join at all.
AIRLINE_FACT = f"""
SELECT {_FACT_COLUMNS}, {_CAUSES}
FROM (SELECT {_MEASURES}, {_EXTRA} FROM {{lineitem}} l) x
"""

FACT = f"""
SELECT {_FACT_COLUMNS}, origin_airport_id, dest_airport_id, {_CAUSES}
FROM (
    SELECT {_MEASURES}, s.s_nationkey AS origin_airport_id, c.c_nationkey AS dest_airport_id, {_EXTRA}
    FROM {{lineitem}} l
    JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
    JOIN {{customer}} c ON o.o_custkey = c.c_custkey
    JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey
) x
"""

DIM_AIRLINE = """
SELECT CAST(s_suppkey AS INT) AS airline_id, s_name AS airline_name,
    'C' || CAST(s_suppkey AS STRING) AS airline_code
FROM {supplier}
"""
# Some airlines are unknown to this dimension, so that checks have something to find.
DIM_AIRLINE_PARTIAL = DIM_AIRLINE + " WHERE s_acctbal > 0"

DIM_AIRPORT = """
SELECT n_nationkey AS airport_id, 'N' || chr(65 + n_nationkey) || 'X' AS airport_code,
    CASE WHEN n_nationkey = 11 THEN NULL ELSE n_name END AS city,
    substr(r_name, 1, 2) AS state_code, r_name AS state, n_name || ' FIELD' AS airport_name,
    CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 3.0 - 36.0 END AS latitude,
    CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE CAST(n_nationkey AS DOUBLE) * 7.0 - 80.0 END AS longitude
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

# Raw flight files: every cell is text; some are padded, lower case, malformed, out of range or
# missing. Different rules break different rows, so that every check has something to find.
_minutes = "CAST({} AS STRING) || '.00'"


def _unless_cancelled(value: str) -> str:
    return f"CASE WHEN x.cancelled = 1 THEN NULL ELSE {value} END"


# The rows behind them, still without the text cells.
BRONZE_ROWS = f"""SELECT {_MEASURES}, s.s_nationkey AS origin_airport_id, c.c_nationkey AS dest_airport_id, {_EXTRA}
    FROM {{lineitem}} l
    JOIN {{orders}} o ON l.l_orderkey = o.o_orderkey
    JOIN {{customer}} c ON o.o_custkey = c.c_custkey
    JOIN {{supplier}} s ON l.l_suppkey = s.s_suppkey"""
_BRONZE_CELLS = f"""
SELECT
    CASE WHEN okey % 89 = 3 THEN NULL ELSE CAST(year(flight_date) AS STRING) END AS Year,
    CASE WHEN okey % 83 = 3 THEN '5' ELSE CAST(quarter(flight_date) AS STRING) END AS Quarter,
    CAST(month(flight_date) AS STRING) AS Month,
    CASE WHEN okey % 79 = 3 THEN '32' ELSE CAST(day(flight_date) AS STRING) END AS DayofMonth,
    CASE WHEN okey % 73 = 3 THEN '8' ELSE CAST(day_of_week AS STRING) END AS DayOfWeek,
    CASE WHEN okey % 71 = 3 THEN 'not a date' ELSE CAST(flight_date AS STRING) END AS FlightDate,
    CAST(airline_id AS STRING) || '.00' AS DOT_ID_Reporting_Airline,
    CASE WHEN okey % 67 = 3 THEN 'abc' ELSE CAST(flight_number AS STRING) END
        AS Flight_Number_Reporting_Airline,
    CAST(origin_airport_id AS STRING) AS OriginAirportID,
    CASE WHEN okey % 61 = 3 THEN 'xx' ELSE '  n' || lower(chr(65 + origin_airport_id)) || 'x ' END AS Origin,
    'City ' || CAST(origin_airport_id AS STRING) || ', S' || chr(65 + origin_airport_id) || ' ' AS OriginCityName,
    ' State ' || CAST(origin_airport_id AS STRING) AS OriginStateName,
    CAST(dest_airport_id AS STRING) AS DestAirportID,
    ' N' || chr(65 + dest_airport_id) || 'x' AS Dest,
    'City ' || CAST(dest_airport_id AS STRING) || ', S' || chr(65 + dest_airport_id) || ' ' AS DestCityName,
    ' State ' || CAST(dest_airport_id AS STRING) AS DestStateName,
    lpad(CAST(pkey % 2400 AS STRING), 4, '0') AS CRSDepTime,
    {_unless_cancelled("lpad(CAST((pkey + 7) % 2400 AS STRING), 4, '0')")} AS DepTime,
    {_unless_cancelled(_minutes.format("dep_delay_minutes - 4"))} AS DepDelay,
    CASE WHEN okey % 59 = 3 THEN '-1.00'
         ELSE {_unless_cancelled(_minutes.format("dep_delay_minutes"))} END AS DepDelayMinutes,
    CASE WHEN okey % 53 = 3 THEN '3'
         WHEN dep_delay_minutes >= 15 THEN '1.00' WHEN dep_delay_minutes < 15 THEN '0.00' END AS DepDel15,
    {_unless_cancelled("CAST(dep_delay_minutes % 12 AS STRING)")} AS DepartureDelayGroups,
    ' ' || dep_time_block AS DepTimeBlk,
    CASE WHEN okey % 47 = 3 THEN '-1.00' ELSE {_unless_cancelled(_minutes.format("pkey % 30"))} END AS TaxiOut,
    {_unless_cancelled("lpad(CAST((pkey + 20) % 2400 AS STRING), 4, '0')")} AS WheelsOff,
    {_unless_cancelled("lpad(CAST((pkey + 90) % 2400 AS STRING), 4, '0')")} AS WheelsOn,
    {_unless_cancelled(_minutes.format("pkey % 12"))} AS TaxiIn,
    '2400' AS CRSArrTime,
    {_unless_cancelled("lpad(CAST((pkey + 99) % 2400 AS STRING), 4, '0')")} AS ArrTime,
    CASE WHEN arr_delay_minutes IS NOT NULL THEN CAST(arr_delay_minutes - 9 AS STRING) || '.00' END AS ArrDelay,
    CASE WHEN arr_delay_minutes IS NOT NULL THEN CAST(arr_delay_minutes AS STRING) || '.00' END AS ArrDelayMinutes,
    CASE WHEN arr_delay_minutes >= 15 THEN '1.00' WHEN arr_delay_minutes < 15 THEN '0.00' END AS ArrDel15,
    CASE WHEN arr_delay_minutes IS NOT NULL THEN CAST(arr_delay_minutes % 12 AS STRING) END AS ArrivalDelayGroups,
    ' 1800-1859 ' AS ArrTimeBlk,
    CASE WHEN okey % 43 = 3 THEN '2.00' ELSE CAST(cancelled AS STRING) || '.00' END AS Cancelled,
    CASE WHEN cancelled = 1 THEN ' b' END AS CancellationCode,
    CAST(diverted AS STRING) || '.00' AS Diverted,
    CAST(pkey % 400 AS STRING) || '.00' AS CRSElapsedTime,
    CASE WHEN okey % 41 = 3 THEN 'NaN' ELSE {_unless_cancelled(_minutes.format("pkey % 380"))} END AS ActualElapsedTime,
    {_unless_cancelled(_minutes.format("pkey % 350"))} AS AirTime,
    CAST(pkey % 97 * 20 AS STRING) || '.00' AS Distance,
    CAST(pkey % 11 + 1 AS STRING) AS DistanceGroup,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(tax AS STRING) || '.00' END AS CarrierDelay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(okey % 11 AS STRING) || '.00' END AS WeatherDelay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(pkey % 13 AS STRING) || '.00' END AS NASDelay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(airline_id % 3 AS STRING) || '.00' END AS SecurityDelay,
    CASE WHEN arr_delay_minutes >= 15 THEN CAST(okey % 17 AS STRING) || '.00' END AS LateAircraftDelay,
    year(flight_date) AS period_year,
    CASE WHEN okey % 101 = 3 THEN month(flight_date) % 12 + 1 ELSE month(flight_date) END AS period_month
"""
BRONZE = f"""{_BRONZE_CELLS}FROM (
    {BRONZE_ROWS}
) x
"""

# Lookup rows: integer and text codes, some missing or malformed, repeated, without a description.
LOOKUP_AIRLINES = """
SELECT CASE WHEN s_suppkey % 23 = 5 THEN 'x' || CAST(s_suppkey AS STRING)
            ELSE ' ' || CAST(s_suppkey - s_suppkey % 3 % 2 AS STRING) END AS Code,
    CASE WHEN s_suppkey % 29 = 7 THEN '  '
         WHEN s_suppkey % 31 = 8 THEN s_name
         WHEN s_suppkey % 37 = 9 THEN 'Old: ' || s_name || ': k' || CAST(s_suppkey AS STRING)
         ELSE s_name || ': k' || CAST(s_suppkey AS STRING) || ' ' END AS Description
FROM {supplier}
"""
LOOKUP_AIRPORTS = """
SELECT CASE WHEN p_partkey % 41 = 5 THEN NULL
            ELSE ' p' || CAST(p_partkey - p_partkey % 2 AS STRING) || ' ' END AS Code,
    CASE WHEN p_partkey % 17 = 4 THEN NULL ELSE p_name END AS Description
FROM {part}
"""
LOOKUP_AIRPORT_IDS = """
SELECT CASE WHEN c_custkey % 19 = 5 THEN CAST(c_custkey AS STRING) || '.5' ELSE CAST(c_custkey AS STRING) END AS Code,
    CASE WHEN c_custkey % 13 = 4 THEN c_name
         ELSE 'City ' || CAST(c_custkey AS STRING) || ', ' || c_mktsegment || ': ' || c_name END AS Description
FROM {customer}
"""
COORDINATES = """
SELECT CASE WHEN c_custkey % 43 = 7 THEN NULL
            ELSE CAST(c_custkey - c_custkey % 5 % 2 AS STRING) END AS AIRPORT_ID,
    ' c' || CAST(c_custkey AS STRING) AS AIRPORT,
    c_name || ' ' AS DISPLAY_AIRPORT_NAME,
    'City ' || CAST(c_custkey AS STRING) AS DISPLAY_AIRPORT_CITY_NAME_FULL,
    ' ' || c_mktsegment AS AIRPORT_STATE_NAME,
    CASE WHEN c_custkey % 47 = 7 THEN 'north' ELSE CAST(c_custkey % 190 - 94 AS STRING) || '.5' END AS LATITUDE,
    CAST(c_custkey % 370 - 184 AS STRING) || '.25' AS LONGITUDE,
    CASE WHEN c_custkey % 7 = 2 THEN '0' ELSE '1' END AS AIRPORT_IS_LATEST
FROM {customer}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bind(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """The input described by one of the texts above."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if "{" + name + "}" in text}
    return spark.sql(text, **used)


def bronze_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``BRONZE``, with those of a month together as its files are. They are dealt before
    they become text, so that the shuffle moves numbers instead of 49 cells."""
    rows = bind(spark, sf_dir, BRONZE_ROWS)
    date = F.col("flight_date")
    month = F.when(F.col("okey") % 101 == 3, F.month(date) % 12 + 1).otherwise(F.month(date))
    dealt = rows.withColumns({"filed_year": F.year(date), "filed_month": month}).hint("rebalance", F.col("filed_year"), F.col("filed_month"))
    return spark.sql(f"{_BRONZE_CELLS}FROM {{rows}} x", rows=dealt)


def in_duckdb(text: str) -> str:
    return text.format(**{name: name for name in TABLES})


# ---- files ------------------------------------------------------------------------------
# Order keys are unique, so a bucket of this many consecutive keys has a bounded number of rows.
ORDERS_PER_FILE = 1000
# A compressed file is read by one task.
ROWS_PER_FLIGHT_FILE = 250_000
ORDER_FILE_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]


def order_cells(orders: DataFrame) -> DataFrame:
    """Orders as text cells: amounts with two decimals, some cells malformed or missing."""
    key = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    amount = F.concat(
        F.call_function("div", cents, F.lit(100)).cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )
    return orders.select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 11 == 3, F.lit(None)).otherwise(F.concat("o_custkey", F.lit(".00"))).alias("o_custkey"),
        F.when(key % 13 == 3, F.lit("n/a")).otherwise(amount).alias("o_totalprice"),
        F.when(key % 17 == 3, F.lit("soon")).otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("o_orderdate"),
        F.concat(F.lit(" "), F.lower("o_orderpriority")).alias("o_orderpriority"),
    )


def write_order_files(spark: SparkSession, sf_dir: str, folder: str, kind: str) -> None:
    """Write the orders as many small files, one per bucket of consecutive keys.

    ``kind`` is ``csv`` or ``zip`` for good files (column order differs between buckets, some have
    a byte-order mark), ``mixed_csv`` or ``mixed_zip`` to damage some of them: of the bucket
    numbers modulo 5, 1 is empty, 2 is not what it claims to be, 3 has a damaged content.
    """
    cells = order_cells(table(spark, sf_dir, "orders")).withColumn(
        "bucket", F.call_function("div", F.col("o_orderkey").cast("long"), F.lit(ORDERS_PER_FILE))
    )
    columns = list(ORDER_FILE_COLUMNS)

    def write_file(rows):
        import io
        import zipfile

        import pandas as pd
        from pyarrow import fs

        bucket = int(rows["bucket"].iloc[0])
        order = columns if bucket % 2 == 0 else columns[::-1]
        damage = bucket % 5 if kind.startswith("mixed") else 0
        if kind == "mixed_csv" and damage == 2:
            order = [c for c in order if c != "o_totalprice"]
        body = rows.sort_values("o_orderkey")[order]
        if kind == "mixed_csv" and damage == 3:
            body = body.iloc[:0]
        content = body.to_csv(index=False).encode("utf-8")
        if bucket % 3 == 0:
            content = b"\xef\xbb\xbf" + content
        extension = kind[-3:]
        if extension == "zip":
            packed = io.BytesIO()
            with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(f"orders_{bucket:06d}.csv", content)
                archive.writestr("readme.txt", "orders")
            content = packed.getvalue()
            if damage == 2:
                content = b"not an archive " * 10
            if damage == 3:
                # A flipped byte inside the first member's compressed data.
                middle = 200
                content = content[:middle] + bytes([content[middle] ^ 0xFF]) + content[middle + 1:]
        if damage == 1:
            content = b""
        file_system, location = fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1)
                                                       if folder.startswith("file:/") and
                                                       not folder.startswith("file:///") else folder)
        file_system.create_dir(location, recursive=True)
        with file_system.open_output_stream(f"{location}/orders_{bucket:06d}.{extension}") as out:
            out.write(content)
        return pd.DataFrame({"bucket": [bucket]})

    cells.groupBy("bucket").applyInPandas(write_file, "bucket long").agg(F.count("*")).collect()

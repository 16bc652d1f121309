"""The registered queries: one per operator, each over the whole given tables."""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import bindings as B
from punctua import schemas as S
from punctua.functions import cells, labels
from punctua.functions.bands import BANDS, reliability_band
from punctua.operators import cumulative, geo, kpi, periods, quality, ranking, reaggregate, reconcile, rules, star, trend
from punctua.operators.cleaning import (
    clean_coordinates, clean_flights, clean_lookup, column_presence, lookup_report,
)
from punctua.operators.dedup import dedup, duplicate_keys
from punctua.plans import month as month_plan
from punctua.plans import silver as silver_plan
from punctua.session import tune
from punctua.sources import buckets, delimited, files, releases, tables
from punctua.sources.storage import scratch_path, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore only avoids a clash here."""

    @functools.wraps(function)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return function(tune(spark), sf)

    QUERIES[function.__name__.rstrip("_")] = run
    return function


# Parameters of the queries.
PERIOD = (1998, 6)
EMPTIED_PERIOD = (1999, 1)
PERIODS = [(1998, 5), (1998, 6), (1999, 12)]
RUN_DATE = dt.date(1998, 8, 2)
MONTHS = 83
# Groups and measures of the KPI tables.
AIRLINE_MEASURES = [
    "on_time_rate_pct", "avg_dep_delay_minutes", "avg_arr_delay_minutes",
    "cancellation_rate_pct", "diversion_rate_pct",
]
AIRLINE_GROUP = ["airline_id", "airline_name", "airline_code"]
AIRPORT_MEASURES = [
    "avg_delay_minutes", "on_time_rate_pct", "cancellation_rate_pct", "diversion_rate_pct",
]
AIRPORT_GROUP = ["airport_id", "airport_code", "airport_name", "city", "state_code", "state"]
ROUTE_GROUP = [
    "origin_airport_id", "origin_airport_code", "origin_airport_name", "origin_city",
    "origin_state_code", "origin_state",
    "dest_airport_id", "dest_airport_code", "dest_airport_name", "dest_city",
    "dest_state_code", "dest_state",
]
ROUTE_MEASURES = reaggregate.ROUTE_MEASURES


# ---- shared inputs ----------------------------------------------------------------------
def _airline_kpi(spark, sf, dim=B.DIM_AIRLINE):
    stats = kpi.flight_stats(B.bind(spark, sf, B.AIRLINE_FACT), kpi.AIRLINE_GRAIN)
    return kpi.airline_kpi(stats, B.bind(spark, sf, dim))


def _route_stats(spark, sf):
    return kpi.flight_stats(B.bind(spark, sf, B.FACT), kpi.ROUTE_GRAIN)


def _staged_route_stats(spark, sf):
    return staged(_route_stats(spark, sf), "stats")


def _airport_kpi(spark, sf):
    return kpi.airport_kpi(_route_stats(spark, sf), B.bind(spark, sf, B.DIM_AIRPORT))


def _route_kpi(spark, sf):
    return kpi.route_kpi(_route_stats(spark, sf), B.bind(spark, sf, B.DIM_AIRPORT))


def _flight_kpi(spark, sf):
    stats = kpi.flight_stats(B.bind(spark, sf, B.FACT), kpi.FLIGHT_GRAIN)
    return kpi.flight_kpi(
        stats, B.bind(spark, sf, B.DIM_AIRLINE), B.bind(spark, sf, B.DIM_AIRPORT)
    )


def _airlines(spark, sf):
    return reaggregate.aggregate_periods(_airline_kpi(spark, sf), AIRLINE_GROUP, AIRLINE_MEASURES)


def _airports(spark, sf, operation):
    return _combined_airports(_airport_kpi(spark, sf), operation)


def _combined_airports(monthly, operation):
    rows = reaggregate.operation_rows(monthly, operation)
    return reaggregate.aggregate_periods(rows, AIRPORT_GROUP, AIRPORT_MEASURES)


def _routes(spark, sf):
    return _combined_routes(_route_kpi(spark, sf))


def _combined_routes(monthly):
    return reaggregate.aggregate_periods(monthly, ROUTE_GROUP, ROUTE_MEASURES)


def _flagged(spark, sf):
    return silver_plan.flag_flights(B.bind(spark, sf, B.BRONZE))


# ---- scans and sinks --------------------------------------------------------------------
def _typed_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        cells.strict_integer(F.col("o_orderkey")).alias("o_orderkey"),
        cells.whole_number(F.col("o_custkey")).alias("o_custkey"),
        F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
        cells.calendar_date(F.col("o_orderdate")).alias("o_orderdate"),
        cells.code_text(F.col("o_orderpriority")).alias("o_orderpriority"),
    )


@query
def scan_csv_typed(spark, sf):
    folder = scratch_path(spark, "orders-csv")
    B.write_order_files(spark, sf, folder, "csv")
    return _typed_orders(delimited.scan_csv(spark, folder, B.ORDER_FILE_COLUMNS, "orders"))


@query
def scan_zipped_csv(spark, sf):
    folder = scratch_path(spark, "orders-zip")
    B.write_order_files(spark, sf, folder, "zip")
    return _typed_orders(delimited.scan_zipped_csv(spark, folder, B.ORDER_FILE_COLUMNS))


@query
def profile_files(spark, sf):
    folder = scratch_path(spark, "orders-csv")
    B.write_order_files(spark, sf, folder, "mixed_csv")
    return files.profile_files(spark, folder, B.ORDER_FILE_COLUMNS, "*.csv").select(
        files.file_name().alias("file_name"), "verdict",
        F.array_join("missing_columns", ",").alias("missing_columns"),
    )


@query
def verify_archives(spark, sf):
    folder = scratch_path(spark, "orders-zip")
    B.write_order_files(spark, sf, folder, "mixed_zip")
    return files.verify_archives(spark, folder).select(
        files.file_name().alias("file_name"), "members", "verdict"
    )


def _fact_with_period(spark, sf):
    return B.bind(spark, sf, B.FACT).withColumns(
        {"year": F.year("flight_date"), "month": F.month("flight_date")}
    )


@query
def scan_period(spark, sf):
    root = scratch_path(spark, "fact")
    tables.write_periods(_fact_with_period(spark, sf), root)
    return tables.scan_period(spark, root, *PERIOD, "fact")


@query
def replace_period(spark, sf):
    root = scratch_path(spark, "kpi")
    monthly = staged(_airline_kpi(spark, sf), "monthly")
    tables.write_periods(monthly, root)
    tables.replace_period(monthly.withColumn("flights", F.col("flights") * 2), root, *PERIOD)
    tables.replace_period(monthly.where("flights < 0"), root, *EMPTIED_PERIOD)
    return spark.read.parquet(root).select(*S.AIRLINE_KPI.names)


@query
def append_rows(spark, sf):
    root = scratch_path(spark, "kpi")
    monthly = staged(_airline_kpi(spark, sf), "monthly")
    tables.append_rows(monthly.where("year <= 1998"), root)
    tables.append_rows(monthly.where("year > 1998"), root)
    return spark.read.parquet(root).select(*S.AIRLINE_KPI.names)


@query
def ensure_table(spark, sf):
    root = scratch_path(spark, "kpi")
    tables.ensure_table(spark, root, S.AIRLINE_KPI)
    tables.append_rows(_airline_kpi(spark, sf), root)
    return tables.ensure_table(spark, root, S.AIRLINE_KPI)


@query
def evolve_schema(spark, sf):
    # Months up to 1998 come from an older layout: fewer columns, in another order.
    monthly = _airline_kpi(spark, sf)
    added = ["dep_delay_flights", "dep_delay_sum_minutes", "arr_delay_flights", "arr_delay_sum_minutes"]
    older = [c for c in reversed(S.AIRLINE_KPI.names) if c not in added]
    old = tables.evolve(monthly.where("year <= 1998").select(*older), S.AIRLINE_KPI)
    return old.unionByName(tables.evolve(monthly.where("year > 1998"), S.AIRLINE_KPI))


def _stale_and_new_airlines(spark, sf):
    dim = B.bind(spark, sf, B.DIM_AIRLINE)
    balance = B.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("airline_id"), "s_acctbal"
    )
    ranked = dim.join(balance, "airline_id")
    stale = ranked.where("s_acctbal < 5000").select(
        "airline_id", F.concat(F.lit("old "), "airline_name").alias("airline_name"), "airline_code"
    )
    return stale, ranked.where("s_acctbal > 0").drop("s_acctbal")


@query
def upsert_dim(spark, sf):
    path = scratch_path(spark, "dim")
    stale, new = _stale_and_new_airlines(spark, sf)
    tables.merge_snapshot(spark, path, stale, ["airline_id"])
    return tables.merge_snapshot(spark, path, new, ["airline_id"])


@query
def upsert_buckets(spark, sf):
    path = scratch_path(spark, "dim")
    stale, new = _stale_and_new_airlines(spark, sf)
    buckets.merge_buckets(spark, path, stale, ["airline_id"])
    return buckets.merge_buckets(spark, path, new, ["airline_id"])


@query
def surrogate_key(spark, sf):
    unique = dedup(B.bind(spark, sf, B.FACT), S.FACT_BUSINESS_KEY).select(*S.FACT_BUSINESS_KEY)
    return tables.with_surrogate_key(unique, [F.col(c) for c in S.FACT_BUSINESS_KEY], "flight_id")


# KPI rows of any dataset in one shape: dataset, month, ids, and two figures.
ENTITY_IDS = {
    "airlines": ["airline_id"], "airports": ["operation", "airport_id"],
    "routes": ["origin_airport_id", "dest_airport_id"],
    "flights": ["airline_id", "flight_number", "origin_airport_id", "dest_airport_id"],
}
PLACES = {
    "airports": ["latitude", "longitude"],
    "routes": ["origin_latitude", "origin_longitude", "dest_latitude", "dest_longitude"],
}


def _long_form(dataset, rows, places=()):
    known = list(places) + [None] * (4 - len(places))
    return rows.select(
        F.lit(dataset).alias("dataset"), "year", "month",
        F.concat_ws("/", *ENTITY_IDS[dataset]).alias("entity"), "flights", "on_time_rate_pct",
        *[(F.col(c) if c else F.lit(None)).cast("double").alias(f"place_{i}") for i, c in enumerate(known)],
    )


@query
def load_gold(spark, sf):
    root, dim = scratch_path(spark, "gold"), B.bind(spark, sf, B.DIM_AIRPORT)
    stats = staged(kpi.flight_stats(B.bind(spark, sf, B.FACT), kpi.FLIGHT_GRAIN), "stats")
    rows = None
    for dataset, table in kpi.kpi_tables_from_stats(stats, B.bind(spark, sf, B.DIM_AIRLINE), dim).items():
        tables.write_periods(table, f"{root}/{S.KPI_TABLES[dataset]}")
        loaded = tables.load_gold(spark, root, dataset, PERIODS, dim)
        part = _long_form(dataset, loaded, PLACES.get(dataset, ()))
        rows = part if rows is None else rows.unionByName(part)
    return rows


# ---- cleaning ---------------------------------------------------------------------------
@query
def require_columns(spark, sf):
    wanted = ["l_orderkey", "l_shipdate", "l_returnflag", "l_commitdate", "l_comment"]
    return column_presence(B.table(spark, sf, "lineitem"), wanted)


@query
def clean_fact(spark, sf):
    return clean_flights(B.bind(spark, sf, B.BRONZE), keep=rules.PERIOD, malformed=True)


LOOKUP_SOURCES = {
    "airlines": B.LOOKUP_AIRLINES, "airports": B.LOOKUP_AIRPORTS, "airport_ids": B.LOOKUP_AIRPORT_IDS,
}


def _lookup(spark, sf, name_):
    return clean_lookup(B.bind(spark, sf, LOOKUP_SOURCES[name_]), **S.LOOKUPS[name_])


@query
def clean_lookup_(spark, sf):
    rows = None
    for name_, config in S.LOOKUPS.items():
        part = _lookup(spark, sf, name_).select(
            F.lit(name_).alias("lookup"),
            F.col(config["code_name"]).cast("string").alias("code"),
            F.col(config["description_name"]).alias("description"),
        )
        rows = part if rows is None else rows.unionByName(part)
    return rows



@query
def lookup_validation(spark, sf):
    rows = None
    for name_, config in S.LOOKUPS.items():
        part = lookup_report(B.bind(spark, sf, LOOKUP_SOURCES[name_]), config["code_type"])
        part = part.withColumn("dataset", F.lit(name_))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def clean_coordinates_(spark, sf):
    return clean_coordinates(B.bind(spark, sf, B.COORDINATES))



@query
def split_label(spark, sf):
    airlines = B.bind(spark, sf, B.LOOKUP_AIRLINES)
    airports = B.bind(spark, sf, B.LOOKUP_AIRPORT_IDS)
    part = B.table(spark, sf, "part")
    label = F.trim("Description")

    def row(kind, source, first, second):
        return source.select(
            F.lit(kind).alias("kind"), label.alias("label"), first.alias("first"), second.alias("second")
        )

    cities = part.select(
        F.concat(F.initcap("p_name"), F.lit(", "), F.upper(F.substring("p_type", 1, 2))).alias("Description")
    )
    return (
        row("name_code", airlines, *cells.split_name_code(label))
        .unionByName(row("name_code_last", airlines, *cells.split_name_code(label, last_colon=True)))
        .unionByName(row("airport_name", airports, cells.airport_name(label), F.lit("")))
        .unionByName(row("city_state", cities, *cells.split_city_state(label)))
    )


# ---- rules ------------------------------------------------------------------------------
@query
def rule_flags(spark, sf):
    names = [r.name for r in rules.period_rules()]
    return rules.unpack_flags(_flagged(spark, sf), rules.period_rules()).select(*rules.PERIOD, *S.FLIGHT_BUSINESS_KEY, *names)


@query
def hard_filter(spark, sf):
    valid, _ = rules.split_valid(_flagged(spark, sf), rules.period_rules())
    return rules.drop_flags(valid, rules.period_rules())


@query
def rejected_rows(spark, sf):
    rejected = rules.rejected_rows(_flagged(spark, sf), rules.period_rules())
    return rejected.select(
        *rules.PERIOD, *S.FLIGHT_BUSINESS_KEY, F.array_join("reasons", ",").alias("reasons")
    )


@query
def validation_report(spark, sf):
    # What the report reads, and no more.
    flagged = staged(_flagged(spark, sf).select(
        *rules.PERIOD, *S.FLIGHT_BUSINESS_KEY, rules.FAILED, rules.UNKNOWN, "malformed_mask"), "flagged")
    return rules.validation_report(flagged, rules.period_rules())


@query
def row_ledger(spark, sf):
    return rules.row_ledger(_flagged(spark, sf), rules.period_rules())


@query
def dedup_business_key(spark, sf):
    return dedup(B.bind(spark, sf, B.FACT), S.FACT_BUSINESS_KEY)


@query
def duplicate_keys_(spark, sf):
    return duplicate_keys(B.bind(spark, sf, B.FACT), S.FACT_BUSINESS_KEY)



# ---- star schema ------------------------------------------------------------------------
@query
def build_fact(spark, sf):
    return star.build_fact(clean_flights(B.bind(spark, sf, B.BRONZE)))


@query
def build_dim_carrier(spark, sf):
    return star.build_dim_airline(_lookup(spark, sf, "airlines"))


@query
def build_dim_location(spark, sf):
    return star.build_dim_airport(
        clean_flights(B.bind(spark, sf, B.BRONZE)),
        _lookup(spark, sf, "airport_ids"),
        clean_coordinates(B.bind(spark, sf, B.COORDINATES)),
    )


# ---- KPI tables -------------------------------------------------------------------------
@query
def carrier_kpi(spark, sf):
    return _airline_kpi(spark, sf)


@query
def airport_kpi(spark, sf):
    return _airport_kpi(spark, sf)


@query
def route_kpi(spark, sf):
    return _route_kpi(spark, sf)


@query
def shipment_kpi(spark, sf):
    return _flight_kpi(spark, sf)


# ---- periods ----------------------------------------------------------------------------
@query
def month_slice(spark, sf):
    return periods.month_slice(B.table(spark, sf, "lineitem"), "l_shipdate", *PERIOD)


@query
def period_catalog(spark, sf):
    return periods.period_catalog(_airline_kpi(spark, sf))


@query
def period_range(spark, sf):
    # The first selected month is in the catalog, the last one is not.
    return periods.period_range(_airline_kpi(spark, sf), selected=[PERIOD, (2030, 1)])


@query
def resolve_period(spark, sf):
    return periods.resolve_period(_airline_kpi(spark, sf), RUN_DATE)


@query
def stored_period_catalog(spark, sf):
    """The catalog of a released table of which one month was emptied, from names alone."""
    root, table = scratch_path(spark, "gold"), S.KPI_TABLES["airlines"]
    rows = staged(_airline_kpi(spark, sf), "airlines")
    releases.release({table: rows}, root)
    releases.release({table: rows.where("false")}, root, [PERIOD])
    return periods.period_catalog(releases.stored_periods(spark, root, table))


# ---- re-aggregation ---------------------------------------------------------------------
@query
def aggregate_periods(spark, sf):
    return _routes(spark, sf)


@query
def range_kpi(spark, sf):
    """Every range of months, from the running sums at its two ends."""
    monthly = staged(_airline_kpi(spark, sf), "monthly")
    stored = staged(cumulative.snapshots(monthly, AIRLINE_GROUP, AIRLINE_MEASURES), "snapshots")
    return cumulative.ranges_kpi(stored, cumulative.all_ranges(monthly), AIRLINE_GROUP, AIRLINE_MEASURES)


@query
def weighted_average(spark, sf):
    return reaggregate.weighted_average(_airline_kpi(spark, sf), AIRLINE_MEASURES)


# Labels of the total rows.
AIRLINE_TOTAL = {"airline_code": "n/a", "airline_name": "All Airlines"}
AIRPORT_TOTAL = {
    "airport_id": None, "airport_code": "n/a", "airport_name": "All Airports",
    "city": "All Airports", "state_code": None, "state": None,
}
ROUTE_TOTAL = {"origin_city": "All Routes", "dest_city": "All Routes", "route": "All Routes"}


@query
def carrier_totals(spark, sf):
    airlines = staged(_airlines(spark, sf), "airlines")
    return reaggregate.with_total(airlines, AIRLINE_TOTAL, AIRLINE_MEASURES, "skip")


@query
def airport_totals(spark, sf):
    monthly = staged(_airport_kpi(spark, sf), "airports")
    rows = None
    for operation in ("DEP", "ARR"):
        part = reaggregate.with_total(
            _combined_airports(monthly, operation), AIRPORT_TOTAL, AIRPORT_MEASURES, "keep"
        ).withColumn("operation", F.lit(operation))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def route_totals(spark, sf):
    routes = staged(_routes(spark, sf), "routes").withColumn("route", labels.route_label())
    return reaggregate.with_total(routes, ROUTE_TOTAL, ROUTE_MEASURES, "keep")


@query
def select_entities(spark, sf):
    wanted = B.table(spark, sf, "supplier").where("s_acctbal > 5000").select("s_name")
    return reaggregate.select_entities(_airlines(spark, sf), "airline_name", wanted)


@query
def min_share(spark, sf):
    return reaggregate.min_share(staged(_routes(spark, sf), "routes"), 0.002)


@query
def min_volume(spark, sf):
    return reaggregate.min_volume(_routes(spark, sf), 1, MONTHS)


@query
def route_pick(spark, sf):
    return reaggregate.route_pick(_routes(spark, sf), origin="NCX")


@query
def route_options(spark, sf):
    routes = staged(_routes(spark, sf), "routes")

    def options(role):
        rows = geo.route_options(routes, role)
        return rows.select(
            F.lit(role).alias("role"),
            *[F.col(f"{role}_{c}").alias(c) for c in ("airport_code", "airport_name", "city", "state_code")],
        )

    return options("origin").unionByName(options("dest"))


@query
def entity_counts(spark, sf):
    return reaggregate.entity_counts(
        _flight_kpi(spark, sf), ["airline_id", "flight_number", "origin_airport_id", "dest_airport_id"]
    )


AIRLINE_PICK = "Supplier#000000001"


@query
def shipment_view(spark, sf):
    monthly = staged(_flight_kpi(spark, sf), "flights")
    everything = reaggregate.flight_number_view(monthly).withColumn("picked", F.lit(False))
    picked = reaggregate.flight_number_view(monthly, AIRLINE_PICK).withColumn("picked", F.lit(True))
    return everything.unionByName(picked)


# ---- ranking ----------------------------------------------------------------------------
@query
def top_routes(spark, sf):
    return ranking.top_n(
        _routes(spark, sf), "avg_arr_delay_minutes", 20, ["origin_airport_id", "dest_airport_id"]
    )


@query
def top_airports(spark, sf):
    return ranking.top_n(_airports(spark, sf, "DEP"), "avg_delay_minutes", 20, ["airport_id"])


@query
def entity_sort(spark, sf):
    stats, dim = _staged_route_stats(spark, sf), B.bind(spark, sf, B.DIM_AIRPORT)
    airports = staged(_combined_airports(kpi.airport_kpi(stats, dim), "DEP"), "airports")
    routes = staged(_combined_routes(kpi.route_kpi(stats, dim)), "routes")
    rows = None
    for mode in ranking.SORT_MODES:
        source = airports if mode.startswith("airport") else routes
        key = F.col("airport_code") if mode.startswith("airport") else labels.route_label()
        part = source.select(F.lit(mode).alias("mode"), ranking.sort_key(mode).alias("order"), key.alias("entity"))
        rows = part if rows is None else rows.unionByName(part)
    return ranking.number_listings(rows, "mode")


@query
def rank_with_total(spark, sf):
    entities = staged(_airlines(spark, sf), "airlines")
    total = reaggregate.total_row(entities, AIRLINE_TOTAL, AIRLINE_MEASURES, "skip")
    rows = None
    for placement, metric, sort_by in [
        ("ranked", "on_time_rate_pct", "metric"),
        ("first", "avg_dep_delay_minutes", "metric"),
        ("both_ends", "avg_arr_delay_minutes", "name"),
        ("omitted", "flights", "metric"),
    ]:
        part = ranking.placed_rows(entities, total, metric, "airline_name", placement, sort_by, ["airline_id"])
        part = part.select(F.lit(placement).alias("placement"), "order", "airline_name", "flights")
        rows = part if rows is None else rows.unionByName(part)
    return ranking.number_listings(rows, "placement")


# ---- series and maps --------------------------------------------------------------------
@query
def kpi_trend(spark, sf):
    return trend.kpi_trend(
        staged(_airline_kpi(spark, sf), "monthly"), "airline_name", AIRLINE_MEASURES, "All Airlines"
    )


@query
def airport_trend(spark, sf):
    monthly = staged(_airport_kpi(spark, sf), "monthly")
    rows = None
    for operation in ("DEP", "ARR"):
        part = trend.kpi_trend(
            reaggregate.operation_rows(monthly, operation), "airport_code", AIRPORT_MEASURES, "All Airports"
        ).withColumn("operation", F.lit(operation))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def route_trend(spark, sf):
    monthly = staged(_route_kpi(spark, sf).withColumn("route", labels.route_label()), "monthly")
    return trend.kpi_trend(monthly, "route", ROUTE_MEASURES, "All Routes")


@query
def route_labels(spark, sf):
    # A few codes and a city are unknown, so that both labels meet NULLs.
    routes = _routes(spark, sf).withColumn(
        "dest_airport_code", F.when(F.col("dest_airport_id") != 7, F.col("dest_airport_code"))
    )
    return routes.select(
        "origin_airport_id", "dest_airport_id",
        labels.route_label().alias("route"),
        labels.display_route().alias("display_route"),
        labels.place_label("dest_city", "dest_airport_code").alias("display_dest"),
    )


@query
def reliability_band_(spark, sf):
    columns = {
        "on_time": "on_time_rate_pct", "delay": "avg_delay_minutes",
        "cancellation": "cancellation_rate_pct", "diversion": "diversion_rate_pct",
    }
    return _airport_kpi(spark, sf).select(
        "year", "month", "operation", "airport_id",
        *[reliability_band(F.col(columns[m]), m).alias(f"{m}_band") for m in BANDS],
    )



@query
def scale_size(spark, sf):
    stats, dim = _staged_route_stats(spark, sf), B.bind(spark, sf, B.DIM_AIRPORT)
    airports = geo.airport_coordinates(_combined_airports(kpi.airport_kpi(stats, dim), "ARR"), dim)
    airports = staged(geo.with_known_coordinates(airports), "airports")
    routes = geo.route_coordinates(_combined_routes(kpi.route_kpi(stats, dim)), dim)
    routes = staged(geo.with_known_coordinates(routes), "routes")
    markers = geo.marker_size(airports).select(
        F.lit("airport").alias("kind"), F.col("airport_code").alias("entity"),
        "flights", F.col("marker_size").alias("size"),
    )
    lines = geo.line_width(routes).select(
        F.lit("route").alias("kind"), labels.route_label().alias("entity"),
        "flights", F.col("line_width").alias("size"),
    )
    return markers.unionByName(lines)


@query
def geo_points(spark, sf):
    routes = geo.route_coordinates(_routes(spark, sf), B.bind(spark, sf, B.DIM_AIRPORT))
    return geo.route_end_points(
        geo.with_known_coordinates(routes), ["flights", "origin_airport_code", "dest_airport_code"]
    )


# ---- quality ----------------------------------------------------------------------------
# Differences set into the KPI tables, which the checksums must find: table, column, what is added, and where.
PLANTED = [
    ("airlines", "flights", 1, "month = 2 AND airline_id % 7 = 0"),
    ("airports", "delay_sum_minutes", 1, "month = 3 AND operation = 'DEP' AND airport_id % 5 = 0"),
    ("airports", "on_time_rate_pct", 1.0, "month = 4 AND operation = 'ARR' AND airport_id % 5 = 0"),
    ("flights", "arr_delay_flights", 1, "month = 6 AND airline_id % 7 = 0"),
]
PLANTED_GAP = "month = 5 AND origin_airport_id % 5 = 0"


def _quality_inputs(spark, sf):
    fact = staged(B.bind(spark, sf, B.FACT), "fact")
    airlines = B.bind(spark, sf, B.DIM_AIRLINE_PARTIAL)
    airports = B.bind(spark, sf, B.DIM_AIRPORT)
    stats = staged(kpi.flight_stats(fact, kpi.FLIGHT_GRAIN), "stats")
    return fact, airlines, airports, kpi.kpi_tables_from_stats(stats, airlines, airports)


@query
def dq_suite(spark, sf):
    return quality.dq_suite(*_quality_inputs(spark, sf))


@query
def quality_gate(spark, sf):
    return quality.gate_summary(quality.dq_suite(*_quality_inputs(spark, sf)))


@query
def gold_checksums(spark, sf):
    """Checksums of KPI tables with a wrong value, a missing or a changed row in one month of each."""
    stats = staged(kpi.flight_stats(B.bind(spark, sf, B.FACT), kpi.FLIGHT_GRAIN), "stats")
    kpis = kpi.kpi_tables_from_stats(stats, B.bind(spark, sf, B.DIM_AIRLINE), B.bind(spark, sf, B.DIM_AIRPORT))

    def changed(table, column, by, where):
        return table.withColumn(column, F.when(F.expr(where), F.col(column) + by).otherwise(F.col(column)))

    for dataset, column, by, where in PLANTED:
        kpis[dataset] = changed(kpis[dataset], column, by, where)
    kpis["routes"] = kpis["routes"].where(f"NOT ({PLANTED_GAP})")
    return reconcile.gold_checksums(stats, kpis)


@query
def presence_check(spark, sf):
    fact, _, _, kpis = _quality_inputs(spark, sf)
    return quality.presence_check(fact, kpis)


# ---- whole jobs -------------------------------------------------------------------------
@query
def silver_build(spark, sf):
    bronze, root = scratch_path(spark, "bronze"), scratch_path(spark, "warehouse")
    (
        B.bronze_by_month(spark, sf).write.partitionBy(*rules.PERIOD).option("header", True)
        .option("compression", "gzip").option("maxRecordsPerFile", B.ROWS_PER_FLIGHT_FILE).csv(bronze)
    )
    scanned = delimited.scan_flight_csv(spark, bronze, S.FLIGHT_COLUMNS)
    silver_plan.build_silver(scanned, root)
    return spark.read.parquet(f"{root}/{silver_plan.FLIGHTS}")


@query
def lookup_build(spark, sf):
    folder, root = scratch_path(spark, "lookups"), scratch_path(spark, "warehouse")
    raw = {**LOOKUP_SOURCES, "airport_coordinates": B.COORDINATES}
    for name_, text in raw.items():
        B.bind(spark, sf, text).write.option("header", True).csv(f"{folder}/{name_}")
    silver_plan.build_silver_lookups(spark, {name_: f"{folder}/{name_}" for name_ in raw}, root, *PERIOD)
    rows = None
    for name_, config in S.LOOKUPS.items():
        part = tables.scan_period(spark, f"{root}/silver/{name_}", *PERIOD).select(
            F.lit(name_).alias("lookup"), F.col(config["code_name"]).cast("string").alias("code"),
            F.col(config["description_name"]).alias("description"))
        rows = part if rows is None else rows.unionByName(part)
    places = tables.scan_period(spark, f"{root}/silver/airport_coordinates", *PERIOD).select(
        F.lit("airport_coordinates").alias("lookup"), F.col("AirportID").cast("string").alias("code"),
        F.col("AirportName").alias("description"))
    return rows.unionByName(places)


def _built_months(spark, sf):
    root = scratch_path(spark, "warehouse")
    silver_plan.build_silver(B.bronze_by_month(spark, sf), root)
    month_plan.load_star_from(
        spark.read.parquet(f"{root}/{silver_plan.FLIGHTS}"),
        _lookup(spark, sf, "airlines"),
        _lookup(spark, sf, "airport_ids"),
        clean_coordinates(B.bind(spark, sf, B.COORDINATES)),
        root,
    )
    month_plan.build_gold(*month_plan.star_tables(spark, root), f"{root}/{month_plan.GOLD}")
    return root


@query
def month_build(spark, sf):
    kpis = month_plan.gold_tables(spark, f"{_built_months(spark, sf)}/{month_plan.GOLD}")
    rows = None
    for dataset, table in kpis.items():
        part = _long_form(dataset, table).drop(*[f"place_{i}" for i in range(4)])
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def publish_month(spark, sf):
    """What readers of the four KPI tables see of a month before, after a failed, and after a good release."""
    root, dims = scratch_path(spark, "gold"), (B.bind(spark, sf, B.DIM_AIRLINE), B.bind(spark, sf, B.DIM_AIRPORT))
    fact = staged(B.bind(spark, sf, B.FACT), "fact")

    def built(rows):
        stats = staged(kpi.flight_stats(rows, kpi.FLIGHT_GRAIN), "stats")
        return {S.KPI_TABLES[d]: tables.evolve(t, S.KPI_SCHEMAS[d]) for d, t in kpi.kpi_tables_from_stats(stats, *dims).items()}

    def seen(phase):
        rows = None
        for dataset, table in month_plan.gold_tables(spark, root).items():
            part = table.groupBy("year", "month").agg(F.count("*").alias("row_count"), F.sum("flights").alias("flights")).select(
                F.lit(phase).alias("phase"), F.lit(dataset).alias("dataset"), "*")
            rows = part if rows is None else rows.unionByName(part)
        return rows

    releases.release(built(fact.where("airline_id % 2 = 0")), root)
    phases = [seen("before")]
    new = built(fact)
    broken = {**new, S.KPI_TABLES["routes"]: new[S.KPI_TABLES["routes"]].withColumn(
        "flights", F.when(F.col("flights") >= 0, F.raise_error(F.lit("broken on purpose")).cast("long")))}
    with contextlib.suppress(Exception):
        releases.release(broken, root, [PERIOD])
    phases.append(seen("failed"))
    releases.release(new, root, [PERIOD])
    phases.append(seen("published"))
    return phases[0].unionByName(phases[1]).unionByName(phases[2])


@query
def month_checks(spark, sf):
    root = _built_months(spark, sf)
    # The lookups of these tables lack some airlines, so the gate refuses; the findings are stored.
    with contextlib.suppress(ValueError):
        month_plan.check_months(spark, root)
    return spark.read.parquet(f"{root}/{month_plan.CHECKS}").select("year", "month", "check_name", "error_count")

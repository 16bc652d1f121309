import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.functions.rates import percent_2dp, ratio_2dp
from punctua.operators import kpi

COLUMNS = list(S.FACT_SOURCES)
FACT_DDL = ", ".join(
    f"{c} {'date' if c == 'flight_date' else 'string' if c == 'dep_time_block' else 'int'}" for c in COLUMNS
)


def random_facts(n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        # A third of all flights belongs to one airline and one route.
        hot = rng.random() < 0.34
        cancelled = int(rng.random() < 0.2)
        diverted = int(not cancelled and rng.random() < 0.1)
        dep = None if cancelled else rng.randrange(0, 40)
        arr = None if cancelled or diverted else rng.randrange(0, 40)
        cause = rng.randrange(0, 30) if arr is not None and arr >= 15 else None
        rows.append((
            dt.date(2026, rng.choice([5, 6]), rng.randrange(1, 29)),
            1 if hot else rng.randrange(1, 6), rng.randrange(1, 4),
            10 if hot else rng.randrange(10, 14), 11 if hot else rng.randrange(10, 14),
            1, "b", dep, arr, cancelled, diverted, cause, None, cause, 0 if cause else None, None,
        ))
    return rows


def dims(spark):
    airlines = spark.createDataFrame([(i, f"Airline {i}", f"A{i}") for i in range(1, 5)], S.DIM_AIRLINE)
    airports = spark.createDataFrame(
        [(i, f"AP{i}", f"City {i}", "ST", "State", f"Field {i}", 1.0, 2.0) for i in range(10, 14)],
        S.DIM_AIRPORT,
    )
    return airlines, airports


def kpi_tables(fact, airlines, airports):
    return kpi.kpi_tables_from_stats(kpi.flight_stats(fact, kpi.FLIGHT_GRAIN), airlines, airports)


def half_up(numerator, denominator, factor=1):
    if not denominator or numerator is None:
        return None
    return float((Decimal(factor * numerator) / denominator).quantize(Decimal("0.01"), ROUND_HALF_UP))


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


def test_half_up_ratio(spark):
    cases = [(1, 8), (5, 1000), (-1, 8), (-5, 1000), (0, 3), (2, 3), (1, 0), (None, 3), (10**13, 7)]
    df = spark.createDataFrame(cases, "n long, d long")
    out = df.select(
        ratio_2dp(F.col("n"), F.col("d")).alias("r"), percent_2dp(F.col("n"), F.col("d")).alias("p")
    ).collect()
    assert [r.r for r in out] == [half_up(n, d) for n, d in cases]
    assert [r.p for r in out] == [half_up(n, d, 100) for n, d in cases]


def test_airline_kpi_against_brute_force(spark):
    facts = random_facts()
    airlines, airports = dims(spark)
    df = spark.createDataFrame(facts, FACT_DDL)
    groups = defaultdict(list)
    for fact in facts:
        row = dict(zip(COLUMNS, fact))
        if row["airline_id"] <= 4:
            groups[row["flight_date"].month, row["airline_id"]].append(row)
    stats = kpi.flight_stats(df, kpi.FLIGHT_GRAIN)
    alone = kpi.airline_kpi(kpi.flight_stats(df, kpi.AIRLINE_GRAIN), airlines)
    for tables in (kpi_tables(df, airlines, airports), {
        **kpi.kpi_tables_from_stats(stats, airlines, airports, kpi.roll_up(stats, kpi.ROUTE_GRAIN)), "airlines": alone,
    }):
        assert {d: t.columns for d, t in tables.items()} == {d: s.names for d, s in S.KPI_SCHEMAS.items()}
        got = {(r.month, r.airline_id): r.asDict() for r in tables["airlines"].collect()}
        assert set(got) == set(groups)
        for key, rows in groups.items():
            on_time = sum(
                not r["cancelled"] and not r["diverted"] and r["arr_delay_minutes"] < 15 for r in rows
            )
            arrivals = [r["arr_delay_minutes"] for r in rows if r["arr_delay_minutes"] is not None]
            assert got[key]["flights"] == len(rows)
            assert got[key]["on_time_rate_pct"] == half_up(on_time, len(rows), 100)
            assert got[key]["avg_arr_delay_minutes"] == half_up(sum(arrivals), len(arrivals))
            assert got[key]["arr_delay_flights"] == len(arrivals)
            assert got[key]["cancellation_rate_pct"] == half_up(sum(r["cancelled"] for r in rows), len(rows), 100)
            # Causes are spread over all flights.
            causes = total(r["carrier_delay"] for r in rows) or 0
            assert got[key]["avg_carrier_delay_minutes"] == half_up(causes, len(rows))


def test_airport_kpi_against_brute_force(spark):
    facts = [dict(zip(COLUMNS, f)) for f in random_facts()]
    airlines, airports = dims(spark)
    df = spark.createDataFrame([tuple(f.values()) for f in facts], FACT_DDL)
    got = {
        (r.operation, r.month, r.airport_id): r
        for r in kpi_tables(df, airlines, airports)["airports"].collect()
    }
    departures, arrivals = defaultdict(list), defaultdict(list)
    for f in facts:
        departures[f["flight_date"].month, f["origin_airport_id"]].append(f)
        arrivals[f["flight_date"].month, f["dest_airport_id"]].append(f)
    assert len(got) == len(departures) + len(arrivals)
    for (month, airport), rows in departures.items():
        row = got["DEP", month, airport]
        on_time = sum(not r["cancelled"] and not r["diverted"] and r["dep_delay_minutes"] < 15 for r in rows)
        assert (row.flights, row.on_time_rate_pct) == (len(rows), half_up(on_time, len(rows), 100))
        assert row.delay_sum_minutes == total(r["dep_delay_minutes"] for r in rows)
    for (month, airport), rows in arrivals.items():
        row = got["ARR", month, airport]
        done = [r for r in rows if not r["cancelled"] and not r["diverted"]]
        on_time = sum(r["arr_delay_minutes"] < 15 for r in done)
        assert (row.flights, row.on_time_rate_pct) == (len(done), half_up(on_time, len(done), 100))
        assert row.cancellation_rate_pct is None and row.diversion_rate_pct is None


def test_arrivals_without_a_completed_flight(spark):
    airlines, airports = dims(spark)
    fact = (dt.date(2026, 6, 1), 1, 1, 10, 11, 1, "b", None, None, 1, 0) + (None,) * 5
    tables = kpi_tables(spark.createDataFrame([fact], FACT_DDL), airlines, airports)
    row = tables["airports"].where("operation = 'ARR'").first()
    assert (row.flights, row.on_time_rate_pct, row.avg_delay_minutes, row.delay_sum_minutes) == (0, None, None, None)
    row = tables["airlines"].first()
    assert (row.on_time_rate_pct, row.cancellation_rate_pct, row.dep_delay_sum_minutes) == (0.0, 100.0, None)


def test_totals_agree_between_tables(spark):
    airlines, airports = dims(spark)
    tables = kpi_tables(spark.createDataFrame(random_facts(), FACT_DDL), airlines, airports)
    flights = {d: t.agg(F.sum("flights")).first()[0] for d, t in tables.items()}
    known_airlines = spark.createDataFrame(random_facts(), FACT_DDL).where("airline_id <= 4").count()
    assert flights["airlines"] == flights["flights"] == known_airlines
    by_operation = {
        r[0]: r[1] for r in tables["airports"].groupBy("operation").agg(F.sum("flights")).collect()
    }
    assert by_operation["DEP"] == flights["routes"] == 600
    assert by_operation["DEP"] >= by_operation["ARR"]


def test_fact_is_aggregated_before_the_joins(spark):
    _, airports = dims(spark)
    df = spark.createDataFrame(random_facts(), FACT_DDL)
    routes = kpi.route_kpi(kpi.flight_stats(df, kpi.ROUTE_GRAIN), airports)
    plan = routes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Join") < plan.index("Aggregate")

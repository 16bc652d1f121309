import datetime as dt

import pytest
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators import quality
from punctua.plans import month, silver
from punctua.plans.steps import Steps
from punctua.sources.releases import published
from punctua.sources.storage import data_files

FLIGHT = {
    "Year": "2026", "Quarter": "2", "Month": "6", "DayofMonth": "15", "DayOfWeek": "1",
    "FlightDate": "2026-06-15", "DOT_ID_Reporting_Airline": "1",
    "Flight_Number_Reporting_Airline": "10", "OriginAirportID": "100", "Origin": "jfk",
    "OriginCityName": "New York, NY", "OriginStateName": "New York", "DestAirportID": "200",
    "Dest": " LAX", "DestCityName": "Los Angeles, CA", "DestStateName": "California",
    "DepDelayMinutes": "4.00", "ArrDelayMinutes": "20.00", "Cancelled": "0.00", "Diverted": "0.00",
    "CarrierDelay": "20.00", "DepTimeBlk": "0600-0659",
}
CHANGES = [
    {}, {}, {"Flight_Number_Reporting_Airline": "11", "ArrDelayMinutes": "5.00", "CarrierDelay": ""},
    {"Flight_Number_Reporting_Airline": "12", "Cancelled": "1.00", "DepDelayMinutes": "",
     "ArrDelayMinutes": "", "CarrierDelay": ""},
    {"Quarter": "5"}, {"FlightDate": "2026-07-01"}, {"Origin": "J1"},
]


def write_bronze(folder, month_number, changes):
    leaf = folder / "year=2026" / f"month={month_number:02d}"
    leaf.mkdir(parents=True, exist_ok=True)
    lines = [",".join(S.FLIGHT_COLUMNS) + ",Extra,"]
    for change in changes:
        row = {**FLIGHT, "Month": str(month_number),
               "FlightDate": f"2026-{month_number:02d}-15", **change}
        lines.append(",".join(f'"{row[c]}"' if c in row else "" for c in S.FLIGHT_COLUMNS) + ",x,")
    (leaf / "flights.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("warehouse")
    bronze, root = base / "bronze", str(base / "out")
    write_bronze(bronze, 6, CHANGES)
    write_bronze(bronze, 5, [{"Flight_Number_Reporting_Airline": "9"}])
    sources = {}
    for name, header, lines in [
        ("airlines", "Code,Description", ['1,"Blue Air: BA"', '2,"Red Air: RA"']),
        ("airports", "Code,Description", ['jfk,"New York, NY: Kennedy"']),
        ("airport_ids", "Code,Description", ['100,"New York, NY: Kennedy"', '200,"Los Angeles, CA: LA Intl"']),
        ("airport_coordinates", ",".join(S.COORDINATE_COLUMNS),
         ['100,JFK,Kennedy,"New York, NY",New York,40.6,-73.8,1']),
    ]:
        folder = base / name
        folder.mkdir()
        (folder / "lookup.csv").write_text("\n".join([header, *lines]) + "\n")
        sources[name] = str(folder)
    for number in (5, 6):
        silver.build_silver_month(spark, str(bronze), root, 2026, number)
        silver.build_silver_lookups(spark, sources, root, 2026, number)
    return root, str(bronze), sources


def test_silver_month(spark, warehouse):
    root = warehouse[0]
    rows = spark.read.parquet(f"{root}/{silver.FLIGHTS}").where("month = 6").collect()
    assert sorted(r.Flight_Number_Reporting_Airline for r in rows) == [10, 11, 12]
    assert {(r.Origin, r.Dest, r.year) for r in rows} == {("JFK", "LAX", 2026)}
    report = {
        r.metric: r.value
        for r in spark.read.parquet(f"{root}/{silver.FLIGHT_REPORT}").where("month = 6").collect()
    }
    assert (report["bronze_rows"], report["rejected_by_validation"], report["duplicates_removed"],
            report["silver_rows"]) == (7, 3, 1, 3)
    assert (report["invalid_quarter"], report["invalid_partition_date"], report["invalid_origin_code"]) == (1, 1, 1)


def test_run_month_end_to_end_twice(spark, warehouse):
    root = warehouse[0]
    month.ensure_tables(spark, root)
    month.run_month(spark, root, 2026, 5)
    first = month.run_month(spark, root, 2026, 6).collect()
    assert len(first) == len(quality.CHECKS) and {r.error_count for r in first} == {0}

    def content():
        kpis = month.gold_tables(spark, f"{root}/{month.GOLD}")
        return {d: sorted(map(str, t.collect())) for d, t in kpis.items()}

    before = content()
    row = month.gold_tables(spark, f"{root}/{month.GOLD}")["airlines"].where("month = 6").first()
    assert (row.flights, row.airline_name, row.airline_code) == (3, "Blue Air", "BA")
    assert (row.on_time_rate_pct, row.avg_arr_delay_minutes, row.cancellation_rate_pct) == (33.33, 12.5, 33.33)
    assert row.avg_carrier_delay_minutes == 6.67
    # Running a month again changes nothing but the keys of its fact rows.
    month.run_month(spark, root, 2026, 6)
    assert content() == before
    fact, _, airports = month.star_tables(spark, root)
    assert fact.select("flight_id").distinct().count() == fact.count() == 4
    kennedy = airports.where("airport_id = 100").first()
    assert (kennedy.city, kennedy.state_code, kennedy.airport_name, kennedy.latitude) == (
        "New York", "NY", "Kennedy", 40.6)
    assert airports.where("airport_id = 200").first().latitude is None


def test_a_run_after_a_failure_resumes(spark, warehouse, monkeypatch):
    root = warehouse[0]
    leaf = f"{root}/{month.FACT}/year=2026/month=5"

    def fail(*_):
        raise RuntimeError("lost")

    def state():
        return set(data_files(spark, leaf)), published(spark, f"{root}/{month.GOLD}").get((2026, 5))

    monkeypatch.setattr(month, "build_gold", fail)
    with pytest.raises(RuntimeError, match="lost"):
        month.run_month(spark, root, 2026, 5, fresh=True)
    star, release = state()
    monkeypatch.undo()
    month.run_month(spark, root, 2026, 5)
    resumed = state()
    assert resumed[0] == star and resumed[1] != release  # the star is not written again, the KPI tables are
    month.run_month(spark, root, 2026, 5)
    assert state() == resumed  # nothing left to do
    silver.build_silver_month(spark, warehouse[1], root, 2026, 5)
    month.run_month(spark, root, 2026, 5)
    again = state()
    assert not again[0] & star and again[1] > resumed[1]  # new input, all steps
    month.run_month(spark, root, 2026, 5, fresh=True)
    assert not state()[0] & again[0]


def test_a_record_cut_short_counts_as_none(spark, tmp_path):
    (tmp_path / "in").mkdir(), (tmp_path / "out").mkdir()
    (tmp_path / "in" / "a").write_text("a")
    runs = []

    def job():
        runs.append(1)
        (tmp_path / "out" / "b").write_text(str(len(runs)))

    def step():
        return Steps(spark, str(tmp_path / "steps")).run("one", [str(tmp_path / "in")], [str(tmp_path / "out")], job)

    assert (step(), step()) == (True, False)
    (tmp_path / "steps" / "one.json").write_text('{"inputs": "')
    (tmp_path / "steps" / ".one.json.crc").unlink(missing_ok=True)
    assert (step(), step()) == (True, False)
    (tmp_path / "out" / "b").unlink()
    assert (step(), step()) == (True, False)  # the output is gone
    (tmp_path / "in" / "a").unlink()
    assert (step(), step()) == (True, True)  # nothing to tell the input by


def scratch_folders(spark):
    from punctua.sources import storage

    root = storage.scratch_path(spark, "x").rsplit("/", 1)[0]
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return {s.getPath().getName() for s in system.listStatus(folder)} if system.exists(folder) else set()


def test_jobs_leave_no_scratch_copies(spark, warehouse):
    root, bronze, _ = warehouse
    before = scratch_folders(spark)
    silver.build_silver_month(spark, bronze, root, 2026, 5)
    month.run_month(spark, root, 2026, 5)
    left = {name.rsplit("-", 1)[0] for name in scratch_folders(spark) - before}
    assert left <= {"heads", "incoming"}  # a row per file, a dimension of one month


def test_a_failing_month_leaves_its_checks_readable(spark, warehouse, tmp_path):
    root = warehouse[0]
    month.run_month(spark, root, 2026, 5)
    day = dt.date(2026, 5, 15)
    fact, airlines, airports = month.star_tables(spark, root)
    other = str(tmp_path / "broken")
    broken = fact.where("month = 5").withColumn("airline_id", F.lit(77)).withColumn("flight_date", F.lit(day))
    broken.write.partitionBy("year", "month").parquet(f"{other}/{month.FACT}")
    month.merge_snapshot(spark, f"{other}/{month.DIM_AIRLINE}", airlines, ["airline_id"])
    month.merge_snapshot(spark, f"{other}/{month.DIM_AIRPORT}", airports, ["airport_id"])
    month.build_gold(broken, airlines, airports, f"{other}/{month.GOLD}")
    month.ensure_tables(spark, other)
    with pytest.raises(ValueError, match="unknown_airlines: 1"):
        month.check_months(spark, other, (2026, 5))
    stored = spark.read.parquet(f"{other}/{month.CHECKS}")
    assert {r.check_name for r in stored.where("error_count <> 0").collect()} == {"unknown_airlines", "fact_vs_airline_gold"}


def test_the_suite_scans_the_fact_once(spark, tmp_path):
    day = dt.date(2026, 6, 1)
    facts(spark, (day, 1, 5, 10, 11, 0, 0)).write.parquet(str(tmp_path / "fact"))
    airlines = spark.createDataFrame([(1,)], "airline_id int")
    airports = spark.createDataFrame([(10,), (11,)], "airport_id int")
    kpi = spark.createDataFrame([(2026, 6, 1, 1.0, 1.0, 1.0)],
        "year int, month int, flights long, on_time_rate_pct double, cancellation_rate_pct double, diversion_rate_pct double")
    kpis = {name: kpi for name in ("airlines", "airports", "routes", "flights")}
    suite = quality.dq_suite(spark.read.parquet(str(tmp_path / "fact")), airlines, airports, kpis, reconcile_routes=True)
    assert {r.check_name: r.error_count for r in suite.collect()} == dict.fromkeys([*quality.CHECKS, "fact_vs_route_gold"], 0)
    assert suite._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan") <= 1


def test_missing_silver_month(spark, warehouse):
    with pytest.raises(FileNotFoundError):
        month.run_month(spark, warehouse[0], 2026, 7)


def facts(spark, *rows):
    ddl = ", ".join(
        f"{c} {'date' if c == 'flight_date' else 'int'}" for c in S.FACT_REQUIRED)
    return spark.createDataFrame(rows, ddl)


def test_quality_checks_find_errors(spark):
    day = dt.date(2026, 6, 1)
    fact = facts(
        spark, (day, 1, 5, 10, 11, 0, 0), (day, 1, 5, 10, 11, 0, 0), (day, 9, 5, 10, 12, 0, 0),
        (day, None, 5, 99, 11, 2, 0), (None, 1, 1, 10, 11, 0, 0),
    )
    airlines = spark.createDataFrame([(1,)], "airline_id int")
    airports = spark.createDataFrame([(10,), (11,)], "airport_id int")
    kpi = spark.createDataFrame(
        [(2026, 6, 2, 101.0, None, 0.0), (2026, 6, 1, None, None, None), (2026, 7, -1, 1.0, 1.0, 1.0)],
        "year int, month int, flights long, on_time_rate_pct double, cancellation_rate_pct double, "
        "diversion_rate_pct double")
    kpis = {"airlines": kpi, "airports": kpi.where("flights = 1"), "routes": kpi, "flights": kpi.where("false")}
    for period in (None, (2026, 6)):
        results = quality.dq_suite(fact, airlines, airports, kpis, period)
        june = {r.check_name: r.error_count for r in results.where("month = 6").collect()}
        assert june == {
            "invalid_required_fields": 1, "invalid_flags": 1, "unknown_airlines": 2,
            "unknown_origin_airports": 1, "unknown_dest_airports": 1, "duplicate_flights": 1,
            "invalid_airline_kpis": 1, "invalid_airport_kpis": 0, "invalid_route_kpis": 1,
            "fact_vs_airline_gold": 1,
        }
    with pytest.raises(ValueError, match="9 failed checks: 2026-06 invalid_required_fields: 1; .*2026-06 fact_vs_airline_gold: 1"):
        quality.quality_gate(results)
    gate = quality.gate_summary(results).first()
    assert (gate.failed_checks, gate.first_failure, gate.passed) == (9, "invalid_required_fields", False)
    clean = results.withColumn("error_count", F.lit(0).cast("long"))
    quality.quality_gate(clean)
    assert tuple(quality.gate_summary(clean).first())[2:] == (0, None, True)

    presence = quality.presence_check(fact, kpis, (2026, 6))
    assert {r.table_name: r.row_count for r in presence.collect()} == {
        "fact_flight": 4, "gold_airline_reliability": 2, "gold_airport_reliability": 1,
        "gold_route_reliability": 2, "gold_flight_reliability": 0,
    }
    with pytest.raises(ValueError, match="empty tables: 2026-06 gold_flight_reliability"):
        quality.require_presence(presence)

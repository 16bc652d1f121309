import datetime as dt

import pytest
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators import rules as R
from punctua.operators.cleaning import clean_flights, require_columns

GOOD = {
    "Origin": "OSL", "Dest": "BGO", "FlightDate": dt.date(2031, 11, 27),
    "DOT_ID_Reporting_Airline": 7, "Flight_Number_Reporting_Airline": 4411,
    "OriginAirportID": 31, "DestAirportID": 32,
    "Cancelled": 0, "Diverted": 0, "DepDel15": 1, "ArrDel15": 0,
    "Year": 2031, "Month": 11, "Quarter": 4, "DayofMonth": 27, "DayOfWeek": 4,
    "DepDelayMinutes": 17, "ArrDelayMinutes": 3, "TaxiOut": 8, "TaxiIn": 4,
    "CRSElapsedTime": 58, "ActualElapsedTime": 44, "AirTime": 32, "Distance": 203,
    "CarrierDelay": 1, "WeatherDelay": 2, "NASDelay": 0, "SecurityDelay": 3, "LateAircraftDelay": 0,
}
SCHEMA = ", ".join(
    f"{c} {'string' if c in ('Origin', 'Dest') else 'date' if c == 'FlightDate' else 'long'}" for c in GOOD
)
STRICT = ["Origin", "Dest", "Cancelled", "Diverted", "FlightDate", "Year", "Month", "Quarter",
          "DayofMonth", "DayOfWeek"]
NULLABLE = ["DepDel15", "ArrDel15", "DepDelayMinutes", "ArrDelayMinutes", "TaxiOut", "TaxiIn",
            "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Distance", "CarrierDelay",
            "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]


def rows(spark, *changes):
    data = [tuple({**GOOD, **change}.values()) for change in changes]
    return spark.createDataFrame(data, SCHEMA)


def flagged(spark, *changes):
    rules = R.flight_rules(2031, 11)
    return R.with_flags(rows(spark, *changes), rules), rules


def test_good_row_passes_every_rule(spark):
    df, rules = flagged(spark, {})
    row = df.first()
    assert len(rules) == 26
    assert all(row[rule.name] is True for rule in rules)


# One broken rule per row: what changes, and the rules that then fail.
BROKEN = [
    ({"Origin": "os"}, {"valid_origin_code"}), ({"Dest": "B60"}, {"valid_dest_code"}),
    ({"Cancelled": 4}, {"valid_cancelled"}), ({"Diverted": -1}, {"valid_diverted"}),
    ({"DepDel15": 6}, {"valid_depdel15"}), ({"ArrDel15": 9}, {"valid_arrdel15"}),
    ({"FlightDate": dt.date(2031, 12, 1)}, {"valid_partition_date"}), ({"Year": 2030}, {"valid_year"}),
    ({"Month": 10}, {"valid_month"}), ({"Quarter": 0}, {"valid_quarter"}),
    ({"DayofMonth": 44}, {"valid_day_of_month"}), ({"DayOfWeek": 0}, {"valid_day_of_week"}),
    ({"Distance": 0}, {"valid_distance"}), ({"TaxiIn": -6}, {"valid_taxi_in"}),
    ({"DepDelayMinutes": -2}, {"valid_dep_delay_minutes"}), ({"ArrDelayMinutes": -9}, {"valid_arr_delay_minutes"}),
    ({"TaxiOut": -3}, {"valid_taxi_out"}), ({"CRSElapsedTime": -40}, {"valid_crs_elapsed_time"}),
    ({"ActualElapsedTime": -5}, {"valid_actual_elapsed_time"}), ({"AirTime": -7}, {"valid_air_time"}),
    ({"CarrierDelay": -8}, {"valid_carrier_delay"}), ({"WeatherDelay": -11}, {"valid_weather_delay"}),
    ({"NASDelay": -12}, {"valid_nas_delay"}), ({"SecurityDelay": -13}, {"valid_security_delay"}),
    ({"LateAircraftDelay": -14}, {"valid_late_aircraft_delay"}), ({"Dest": "OSL"}, {"valid_route"}),
]


def test_each_broken_rule_fails_alone(spark):
    df, rules = flagged(spark, *[{**change, "Flight_Number_Reporting_Airline": i} for i, (change, _) in enumerate(BROKEN)])
    found = {r.Flight_Number_Reporting_Airline: {x.name for x in rules if r[x.name] is False} for r in df.collect()}
    assert [found[i] for i in range(len(BROKEN))] == [fails for _, fails in BROKEN]
    assert set().union(*found.values()) == {x.name for x in rules}


@pytest.mark.parametrize("change, valid", [
    ({"Dest": "OSL"}, False),
    ({"Dest": "OSL", "Cancelled": 1}, True),
    ({"Dest": "OSL", "Diverted": 1}, True),
])
def test_route_rule(spark, change, valid):
    df, _ = flagged(spark, change)
    assert df.first()["valid_route"] is valid


def test_trailing_newline_is_no_airport_code(spark):
    df, _ = flagged(spark, {"Origin": "OSL\n"})
    assert df.first()["valid_origin_code"] is False


@pytest.mark.parametrize("column", STRICT)
def test_null_in_a_strict_column_rejects(spark, column):
    df, rules = flagged(spark, {column: None})
    valid, rejected = R.split_valid(df, rules)
    assert (valid.count(), rejected.count()) == (0, 1)
    reasons = R.rejected_rows(df, rules).first()["reasons"]
    assert reasons and all(r.startswith(("missing_", "unknown_")) for r in reasons)


@pytest.mark.parametrize("column", NULLABLE)
def test_null_in_a_nullable_column_is_valid(spark, column):
    df, rules = flagged(spark, {column: None})
    assert R.split_valid(df, rules)[0].count() == 1


def test_report_reconciles(spark):
    df, rules = flagged(
        spark, {}, {}, {"Flight_Number_Reporting_Airline": 11}, {"Quarter": None}, {"Cancelled": 2},
        {"Distance": -5},
    )
    report = {r.metric: r.value for r in R.validation_report(df, rules, by=()).collect()}
    assert report["bronze_rows"] == 6
    assert report["rejected_by_validation"] == 2
    assert report["duplicates_removed"] == 2
    assert report["silver_rows"] == 2
    assert report["total_rejected"] == 4
    assert report["unknown_quarter"] == 1 and report["invalid_quarter"] == 0
    assert report["invalid_cancelled"] == 1 and report["invalid_distance"] == 1
    assert R.valid_unique(df, rules).count() == 2


def test_report_of_no_rows_is_zero(spark):
    df, rules = flagged(spark, {})
    report = R.validation_report(df.where("false"), rules, by=()).collect()
    assert len(report) == 7 + 26 + 11 + 6
    assert {r.value for r in report} == {0}


def raw_row(spark, **cells):
    return spark.createDataFrame(
        [tuple(cells.get(c) for c in S.FLIGHT_COLUMNS)], ", ".join(f"`{c}` string" for c in S.FLIGHT_COLUMNS)
    )


@pytest.mark.parametrize("text, number", [
    ("12.00", 12), ("-3.00", -3), ("0815", 815), ("2400", 2400), ("-0.9", 0), ("", None),
    ("abc", None), ("NaN", None), ("1e20", None), (" 7 ", 7), (None, None),
])
def test_number_cells(spark, text, number):
    assert clean_flights(raw_row(spark, DepDelay=text)).first()["DepDelay"] == number


def test_text_and_date_cells(spark):
    row = clean_flights(raw_row(
        spark, Origin=" jfk ", OriginCityName=" New York, NY ", FlightDate="2026-06-15", Dest="\tx"
    )).first()
    assert (row.Origin, row.OriginCityName, row.FlightDate) == (
        "JFK", "New York, NY", dt.date(2026, 6, 15))
    # trim removes spaces only.
    assert row.Dest == "\tX"
    assert clean_flights(raw_row(spark, FlightDate="june")).first()["FlightDate"] is None


def test_malformed_cells_are_counted(spark):
    raw = raw_row(spark, DepDelay="abc", FlightDate="june", TaxiOut="", Year="2026")
    cleaned = clean_flights(raw, malformed=True)
    mask = cleaned.first()["malformed_mask"]
    assert {c for i, c in enumerate(R.TYPED_COLUMNS) if mask >> i & 1} == {"DepDelay", "FlightDate"}
    rules = R.flight_rules(2031, 11)
    counts = {
        r.metric: r.value for r in R.count_violations(R.with_flags(cleaned, rules), rules, ()).collect()
    }
    assert counts["malformed_DepDelay"] == 1 and counts["malformed_TaxiOut"] == 0


def test_missing_columns_are_named():
    require_columns(S.FLIGHT_COLUMNS, S.FLIGHT_COLUMNS)
    with pytest.raises(ValueError, match="FlightDate"):
        require_columns([c for c in S.FLIGHT_COLUMNS if c != "FlightDate"], S.FLIGHT_COLUMNS)


def test_words_carry_every_outcome(spark):
    changes = [{}, {"Quarter": None, "Origin": "x"}, {"Dest": None}, {"Distance": 0, "TaxiIn": None}, {"DOT_ID_Reporting_Airline": None}]
    df, rules = flagged(spark, *changes)
    names = [rule.name for rule in rules]
    plain = rows(spark, *changes).withColumns({rule.name: rule.flag() for rule in rules})
    assert df.select(*names).collect() == plain.select(*names).collect()
    missing = [row.rule_failed >> len(rules) for row in df.collect()]
    assert missing == [0, 0, 1 << list(R.MANDATORY).index("Dest"), 0, 1 << list(R.MANDATORY).index("DOT_ID_Reporting_Airline")]


def test_report_of_written_rows_is_the_report(spark):
    changes = [{}, {}, {"Flight_Number_Reporting_Airline": 11}, {"Quarter": None}, {"Cancelled": 2}, {"Month": 5, "Year": None}]
    rules = R.period_rules()
    df = R.with_words(rows(spark, *changes).withColumns({"period_year": F.lit(2031), "period_month": F.col("Month").cast("int")}), rules)
    written = R.report_of_written(R.count_words(df), R.valid_unique(df, rules), rules)
    assert sorted(written.collect()) == sorted(R.validation_report(df, rules).collect())


def exchanges_on_key(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("Exchange" in line and "Flight_Number_Reporting_Airline" in line for line in plan.splitlines())


def test_cleaned_rows_and_report_shuffle_the_business_key_once(spark, tmp_path):
    rules = R.period_rules()
    df = R.with_words(rows(spark, {}, {}).withColumns({"period_year": F.lit(2031), "period_month": F.lit(11)}), rules)
    df.write.parquet(str(tmp_path / "flagged"))
    stored = spark.read.parquet(str(tmp_path / "flagged"))
    silver = R.valid_unique(stored, rules)
    silver.write.parquet(str(tmp_path / "silver"))
    report = R.report_of_written(R.count_words(stored), spark.read.parquet(str(tmp_path / "silver")), rules)
    assert (exchanges_on_key(silver), exchanges_on_key(report)) == (1, 0)


def test_flags_of_many_periods_at_once(spark):
    df = rows(spark, {}, {"Month": 5, "FlightDate": dt.date(2031, 5, 2)}).withColumns(
        {"period_year": F.lit(2031), "period_month": F.col("Month").cast("int")}
    )
    flags = R.with_flags(df, R.period_rules()).select("valid_partition_date", "valid_month").collect()
    assert all(all(row) for row in flags)


def test_rows_whose_key_occurs_once_are_not_shuffled(spark, tmp_path):
    changes = [{"Flight_Number_Reporting_Airline": n % 40 if n % 9 else None, "TaxiOut": n, "Cancelled": 4 if n % 7 == 0 else 0} for n in range(60)]
    df, rules = flagged(spark, *changes, {"Origin": None}, {"Origin": None})
    df.drop(*[r.name for r in rules]).write.parquet(str(tmp_path / "flagged"))
    stored = spark.read.parquet(str(tmp_path / "flagged"))
    repeated = R.repeated_keys(stored, rules).localCheckpoint()
    found = R.valid_unique_in_place(stored, repeated, rules)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, R.valid_unique(stored, rules).collect()))
    assert 0 < repeated.count() < found.count()
    once, several = found._jdf.queryExecution().optimizedPlan().toString().split("\n+- ", 1)
    assert "LeftAnti" in once and "Window" not in once and "Window" in several


def test_compressed_files_are_scanned(spark, tmp_path):
    from punctua.sources import delimited, files

    spark.createDataFrame([("1", "x"), ("2", None)], "b string, a string").coalesce(1).write.option("header", True).option(
        "compression", "gzip").csv(str(tmp_path / "in"))
    assert sorted((tuple(r)[:2] for r in delimited.scan_csv(spark, str(tmp_path / "in"), ["a", "b"]).collect()), key=repr, reverse=False) == [("x", "1"), (None, "2")]
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.csv.gz").write_bytes(b"no archive")
    verdicts = files.profile_files(spark, str(tmp_path / "bad"), ["a"], files.CSV_PATTERN).collect()
    assert [r.verdict for r in verdicts] == ["undecodable"]

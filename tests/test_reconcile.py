import pytest
from pyspark.sql import functions as F
from test_kpi import FACT_DDL, dims, kpi_tables, random_facts

from punctua.operators import kpi, quality, reconcile


@pytest.fixture(scope="module")
def built(spark):
    known = [f for f in random_facts() if f[1] <= 4]
    fact = spark.createDataFrame(known, FACT_DDL)
    stats = kpi.flight_stats(fact, kpi.FLIGHT_GRAIN).cache()
    return fact, stats, {d: t.cache() for d, t in kpi_tables(fact, *dims(spark)).items()}


def found(stats, kpis):
    return {(r.month, r.check_name): r.error_count for r in reconcile.gold_checksums(stats, kpis).collect()}


def test_tables_made_of_the_fact_agree(built):
    _, stats, kpis = built
    errors = found(stats, kpis)
    assert set(errors) == {(m, c) for m in (5, 6) for c in reconcile.CHECKSUMS} and not any(errors.values())


@pytest.mark.parametrize("check, change", [
    ("airline_checksum", lambda t: t.withColumn("flights", F.col("flights") + F.when(F.col("airline_id") < 3, F.col("airline_id") * 2 - 3).otherwise(0))),
    ("departure_checksum", lambda t: t.withColumn("delay_sum_minutes", F.expr("delay_sum_minutes + if(operation = 'DEP', 1, 0)"))),
    ("arrival_checksum", lambda t: t.withColumn("on_time_rate_pct", F.expr("on_time_rate_pct + if(operation = 'ARR', 0.01D, 0D)"))),
    ("route_checksum", lambda t: t.where("NOT (origin_airport_id = 10 AND dest_airport_id = 11)")),
    ("flight_checksum", lambda t: t.unionByName(t.where("airline_id = 1"))),
    ("route_checksum", lambda t: t.withColumn("diversion_rate_pct", F.lit(None).cast("double"))),
    ("flight_checksum", lambda t: t.where("false")),
])
def test_a_difference_is_found_in_its_table_and_month(built, check, change):
    _, stats, kpis = built
    dataset = reconcile.DATASETS[check]
    june = change(kpis[dataset].where("month = 6")).unionByName(kpis[dataset].where("month = 5"))
    errors = found(stats, {**kpis, dataset: june})
    assert {key for key, count in errors.items() if count} == {(6, check)}


def test_unknown_airlines_count_their_flights(spark):
    facts = random_facts()
    fact = spark.createDataFrame(facts, FACT_DDL)
    stats = kpi.flight_stats(fact, kpi.FLIGHT_GRAIN)
    errors = found(stats, kpi_tables(fact, *dims(spark)))
    lost = sum(f[1] == 5 and f[0].month == 6 for f in facts)
    assert lost and errors[6, "airline_checksum"] == errors[6, "flight_checksum"] == lost
    assert errors[6, "route_checksum"] == errors[6, "departure_checksum"] == 0


def test_option_of_the_suite(spark, built):
    fact, stats, kpis = built
    wrong = {**kpis, "airports": kpis["airports"].withColumn("flights", F.col("flights") + 2)}
    rows = quality.dq_suite(fact, *dims(spark), wrong, (2026, 6), stats=stats)
    errors = {r.check_name: r.error_count for r in rows.collect()}
    assert set(errors) == {*quality.CHECKS, *reconcile.CHECKSUMS}
    assert errors["departure_checksum"] > 0 < errors["arrival_checksum"] and errors["route_checksum"] == 0
    verdict = quality.gate_summary(rows.where(F.col("check_name").isin(reconcile.CHECKSUMS))).first()
    assert (verdict.failed_checks, verdict.first_failure) == (2, "departure_checksum")


def test_no_rows(spark, built):
    _, stats, kpis = built
    assert found(stats.where("false"), {d: t.where("false") for d, t in kpis.items()}) == {}

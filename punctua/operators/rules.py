"""Declarative validation rules with three-valued outcomes, and the reports built on them.

A rule is true, false or unknown (NULL) per row. Hard rules reject a row unless they are true;
soft rules are only reported.

Outcomes travel as two packed words per row: in ``rule_failed`` bit *i* says that rule *i* is false, the bits
after the rules that a mandatory column is missing; in ``rule_unknown`` bit *i* says that rule *i* is
neither true nor false. Rows are accepted by a mask, and reports count equal words before they look at
single bits, so no job handles a column per rule.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctua import schemas as S
from punctua.operators.cleaning import TYPED_COLUMNS
from punctua.operators.dedup import dedup

HARD, SOFT = "hard", "soft"
PERIOD = ("period_year", "period_month")

# Mandatory column -> name of its report line.
MANDATORY = {
    "FlightDate": "missing_flight_date",
    "DOT_ID_Reporting_Airline": "missing_airline_id",
    "Flight_Number_Reporting_Airline": "missing_flight_number",
    "OriginAirportID": "missing_origin_airport_id",
    "Origin": "missing_origin",
    "DestAirportID": "missing_dest_airport_id",
    "Dest": "missing_dest",
}
# \z rather than $: Java's $ would accept a trailing newline.
AIRPORT_CODE = r"^[A-Z]{3}\z"


@dataclass(frozen=True)
class Rule:
    """``condition`` must hold; with ``nullable`` a missing subject is acceptable too."""

    name: str
    condition: Column
    severity: str
    nullable: Column | None = None

    def flag(self) -> Column:
        if self.nullable is None:
            return self.condition
        return self.nullable.isNull() | self.condition

    @property
    def report_line(self) -> str:
        return "invalid_" + self.name.removeprefix("valid_")


def flight_rules(year: int | Column, month: int | Column) -> list[Rule]:
    """The 26 rules for a period. Pass columns as the period to check many periods at once."""
    col = F.col

    def strict(name, condition):
        return Rule(name, condition, HARD)

    def optional(name, column, test):
        return Rule(name, test(col(column)), SOFT, nullable=col(column))

    def flag_value(c):
        return c.isin(0, 1)

    def not_negative(c):
        return c >= 0

    return [
        strict("valid_origin_code", col("Origin").rlike(AIRPORT_CODE)),
        strict("valid_dest_code", col("Dest").rlike(AIRPORT_CODE)),
        # A return to the gate is a valid route when the flight did not take place as planned.
        strict(
            "valid_route",
            (col("Origin") != col("Dest")) | (col("Cancelled") == 1) | (col("Diverted") == 1),
        ),
        strict("valid_cancelled", flag_value(col("Cancelled"))),
        strict("valid_diverted", flag_value(col("Diverted"))),
        optional("valid_depdel15", "DepDel15", flag_value),
        optional("valid_arrdel15", "ArrDel15", flag_value),
        strict(
            "valid_partition_date",
            (F.year("FlightDate") == year) & (F.month("FlightDate") == month),
        ),
        strict("valid_year", col("Year") == year),
        strict("valid_month", col("Month") == month),
        strict("valid_quarter", col("Quarter").between(1, 4)),
        strict("valid_day_of_month", col("DayofMonth").between(1, 31)),
        strict("valid_day_of_week", col("DayOfWeek").between(1, 7)),
        optional("valid_dep_delay_minutes", "DepDelayMinutes", not_negative),
        optional("valid_arr_delay_minutes", "ArrDelayMinutes", not_negative),
        optional("valid_taxi_out", "TaxiOut", not_negative),
        optional("valid_taxi_in", "TaxiIn", not_negative),
        optional("valid_crs_elapsed_time", "CRSElapsedTime", not_negative),
        optional("valid_actual_elapsed_time", "ActualElapsedTime", not_negative),
        optional("valid_air_time", "AirTime", not_negative),
        optional("valid_distance", "Distance", lambda c: c > 0),
        optional("valid_carrier_delay", "CarrierDelay", not_negative),
        optional("valid_weather_delay", "WeatherDelay", not_negative),
        optional("valid_nas_delay", "NASDelay", not_negative),
        optional("valid_security_delay", "SecurityDelay", not_negative),
        optional("valid_late_aircraft_delay", "LateAircraftDelay", not_negative),
    ]


def period_rules() -> list[Rule]:
    """The flight rules against the period each row was filed under."""
    return flight_rules(F.col(PERIOD[0]), F.col(PERIOD[1]))


FAILED, UNKNOWN = "rule_failed", "rule_unknown"


def _bit(place: int) -> Column:
    return F.lit(1 << place).cast("long")


def _is_set(word: str, place: int) -> Column:
    return F.col(word).bitwiseAND(_bit(place)) != 0


def _packed(conditions: list[Column], first: int = 0) -> Column:
    """A word with bit ``first + i`` set where condition *i* is true."""
    word = F.lit(0).cast("long")
    for place, condition in enumerate(conditions, first):
        word = word.bitwiseOR(F.when(condition, _bit(place)).otherwise(F.lit(0).cast("long")))
    return word


def with_words(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The outcomes of all rules and the missing mandatory columns as two packed words."""
    # The flags are columns first: both words read them, so Catalyst evaluates each rule once.
    flagged = df.withColumns({f"_{rule.name}": rule.flag() for rule in rules})
    failed = _packed([~F.col(f"_{rule.name}") for rule in rules]).bitwiseOR(
        _packed([F.col(c).isNull() if c in df.columns else F.lit(False) for c in MANDATORY], len(rules)))
    unknown = _packed([F.col(f"_{rule.name}").isNull() for rule in rules])
    return flagged.select(*df.columns, failed.alias(FAILED), unknown.alias(UNKNOWN))


def unpack_flags(words: DataFrame, rules: list[Rule]) -> DataFrame:
    """One nullable boolean column per rule, from the packed words."""
    return words.withColumns({
        rule.name: F.when(~_is_set(UNKNOWN, i), ~_is_set(FAILED, i)) for i, rule in enumerate(rules)
    })


def with_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The packed words and one nullable boolean column per rule."""
    return unpack_flags(with_words(df, rules), rules)


def drop_flags(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return df.drop(*[rule.name for rule in rules], FAILED, UNKNOWN, "malformed_mask")


def all_hard(rules: list[Rule]) -> Column:
    """True only when every mandatory column is filled and every hard rule holds."""
    hard = sum(1 << i for i, rule in enumerate(rules) if rule.severity == HARD)
    missing = sum(1 << i for i in range(len(rules), len(rules) + len(MANDATORY)))
    return (F.col(FAILED).bitwiseAND(F.lit(hard | missing).cast("long")) == 0) & (
        F.col(UNKNOWN).bitwiseAND(F.lit(hard).cast("long")) == 0)


def split_valid(flagged: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); together they are exactly the input."""
    return flagged.where(all_hard(rules)), flagged.where(~all_hard(rules))


def rejected_rows(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rejected rows with ``reasons``: missing columns, failed rules, rules that are unknown."""
    reasons = [F.when(_is_set(FAILED, i), F.lit(line)) for i, line in enumerate(MANDATORY.values(), len(rules))]
    for i, rule in enumerate(rules):
        if rule.severity == HARD:
            reasons.append(
                F.when(_is_set(FAILED, i), F.lit(rule.report_line)).when(
                    _is_set(UNKNOWN, i), F.lit("unknown_" + rule.name.removeprefix("valid_"))
                )
            )
    rejected = split_valid(flagged, rules)[1]
    return rejected.withColumn("reasons", F.array_compact(F.array(*reasons)))


def count_words(flagged: DataFrame, by: Iterable[str] = PERIOD) -> DataFrame:
    """Rows ``n`` per period and combination of packed words: few of them, combined before the shuffle."""
    words = [FAILED, UNKNOWN, *(["malformed_mask"] if "malformed_mask" in flagged.columns else [])]
    return flagged.groupBy(*by, *words).agg(F.count("*").alias("n"))


def count_violations(flagged: DataFrame, rules: list[Rule], by: Iterable[str] = PERIOD) -> DataFrame:
    """All rule counts, long form: ``*by, section, metric, value``.

    Sections: ``hard`` (missing and invalid), ``soft``, ``unknown`` (hard rules that are neither
    true nor false, so that rejections reconcile) and ``malformed`` when the mask is present.
    """
    return _violations(count_words(flagged, by), rules, list(by))


def _rows(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0).cast("long"))


def _violations(words: DataFrame, rules: list[Rule], by: list[str]) -> DataFrame:
    measures: dict[str, Column] = {}
    for i, line in enumerate(MANDATORY.values(), len(rules)):
        measures[f"hard.{line}"] = _is_set(FAILED, i)
    for i, rule in enumerate(rules):
        measures[f"{rule.severity}.{rule.report_line}"] = _is_set(FAILED, i)
        if rule.severity == HARD:
            measures["unknown.unknown_" + rule.name.removeprefix("valid_")] = _is_set(UNKNOWN, i)
    if "malformed_mask" in words.columns:
        for i, column in enumerate(TYPED_COLUMNS):
            measures[f"malformed.malformed_{column}"] = _is_set("malformed_mask", i)
    counted = words.groupBy(*by).agg(*[_rows(c).alias(m) for m, c in measures.items()])
    return _long(counted, by, list(measures))


def _long(counted: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    values = [F.col(f"`{m}`") for m in measures]
    return (
        counted.unpivot([F.col(c) for c in by], values, "line", "value")
        .select(
            *by,
            F.split_part("line", F.lit("."), F.lit(1)).alias("section"),
            F.split_part("line", F.lit("."), F.lit(2)).alias("metric"),
            "value",
        )
    )


LEDGER = [
    "bronze_rows", "rejected_by_validation", "valid_rows", "duplicates_removed",
    "total_rejected", "silver_rows",
]


def row_ledger(
    flagged: DataFrame, rules: list[Rule], keys: list[str] = S.FLIGHT_BUSINESS_KEY,
    by: Iterable[str] = PERIOD,
) -> DataFrame:
    """Row counts from raw to deduplicated rows, per period, from one scan.

    Rows are counted per business key with map-side combining; the number of valid keys is the
    number of rows that deduplication keeps.
    """
    by = list(by)
    marked = flagged.withColumn("_ok", all_hard(rules))
    per_key = marked.groupBy(
        *by, "_ok", *[F.when(F.col("_ok"), F.col(k)).alias(k) for k in keys]
    ).agg(F.count("*").alias("n"))
    counts = per_key.groupBy(*by).agg(
        _rows(F.lit(True)).alias("bronze_rows"), _rows(F.col("_ok")).alias("valid_rows"),
        F.count_if(F.col("_ok")).alias("silver_rows"),
    )
    return _ledger(counts, by)


def _ledger(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.withColumns({
        "rejected_by_validation": F.col("bronze_rows") - F.col("valid_rows"),
        "duplicates_removed": F.col("valid_rows") - F.col("silver_rows"),
        "total_rejected": F.col("bronze_rows") - F.col("silver_rows"),
    }).select(*by, *LEDGER)


def _ledger_lines(ledger: DataFrame, by: list[str]) -> DataFrame:
    named = ledger.withColumnsRenamed({m: f"result.{m}" for m in LEDGER})
    return _long(named, by, [f"result.{m}" for m in LEDGER])


def validation_report(
    flagged: DataFrame, rules: list[Rule], keys: list[str] = S.FLIGHT_BUSINESS_KEY,
    by: Iterable[str] = PERIOD,
) -> DataFrame:
    """The whole report as rows ``*by, section, metric, value``: rule counts plus the ledger.

    With ``by=()`` an input without rows gives a report of zeros. ``flagged`` is read twice; stage
    it when it is costly.
    """
    by = list(by)
    return count_violations(flagged, rules, by).unionByName(
        _ledger_lines(row_ledger(flagged, rules, keys, by), by))


def report_of_written(words: DataFrame, silver: DataFrame, rules: list[Rule], by: Iterable[str] = PERIOD) -> DataFrame:
    """The same report after the cleaned rows are written: from the counted words of all rows (see
    ``count_words``) and the rows of ``silver`` per period. No look at the business key: that of
    the write's deduplication is the only one."""
    by = list(by)
    raw = words.groupBy(*by).agg(_rows(F.lit(True)).alias("bronze_rows"), _rows(all_hard(rules)).alias("valid_rows"))
    kept = silver.groupBy(*by).agg(F.count("*").alias("silver_rows"))
    counts = raw.join(kept, by, "left").withColumn("silver_rows", F.coalesce("silver_rows", F.lit(0).cast("long")))
    return _violations(words, rules, by).unionByName(_ledger_lines(_ledger(counts, by), by))


def valid_unique(flagged: DataFrame, rules: list[Rule], keys: list[str] = S.FLIGHT_BUSINESS_KEY) -> DataFrame:
    """Valid rows, one per business key, without the helper columns."""
    return dedup(drop_flags(split_valid(flagged, rules)[0], rules), keys)


KEY_HASH = "key_hash"


def repeated_keys(flagged: DataFrame, rules: list[Rule], keys: list[str] = S.FLIGHT_BUSINESS_KEY) -> DataFrame:
    """``key_hash`` of the business keys that more than one valid row has. Only hashes are shuffled."""
    hashes = split_valid(flagged, rules)[0].select(F.xxhash64(*keys).alias(KEY_HASH))
    return hashes.groupBy(KEY_HASH).agg(F.count("*").alias("n")).where("n > 1").select(KEY_HASH)


def valid_unique_in_place(
    flagged: DataFrame, repeated: DataFrame, rules: list[Rule], keys: list[str] = S.FLIGHT_BUSINESS_KEY,
) -> DataFrame:
    """The rows of ``valid_unique``, where ``repeated`` (see ``repeated_keys``) fits a broadcast: rows
    whose key occurs once stay in the tasks that read them, only the others are shuffled. Keys that
    merely share a hash are told apart by the deduplication of those."""
    match = F.xxhash64(*[flagged[k] for k in keys]) == repeated[KEY_HASH]
    once = flagged.join(F.broadcast(repeated), match, "left_anti")
    several = flagged.join(F.broadcast(repeated), match, "left_semi")
    return drop_flags(split_valid(once, rules)[0], rules).unionByName(valid_unique(several, rules, keys))

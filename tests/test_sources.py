import datetime as dt
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctua import schemas as S
from punctua.sources import delimited, files, storage, tables


def csv_folder(tmp_path, **contents):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, content in contents.items():
        data = content if isinstance(content, bytes) else content.encode()
        (folder / f"{name}.csv").write_bytes(data)
    return str(folder)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


# ---- delimited files --------------------------------------------------------------------
def test_columns_are_matched_by_name_in_every_file(spark, tmp_path):
    folder = csv_folder(
        tmp_path, a='A,B,\n1,"x, y",\n', b="B,C,A\nq,9,2\n", c=b"\xef\xbb\xbfA,B,\n3,\n", d="A,B,\n", e="",
    )
    scan = delimited.scan_csv(spark, folder, ["A", "B"])
    assert {(r.A, r.B) for r in scan.collect()} == {("1", "x, y"), ("2", "q"), ("3", None)}


def test_only_selected_cells_are_parsed(spark, tmp_path):
    folder = csv_folder(tmp_path, a="A,B,C\n1,2,3\n")
    plan = delimited.scan_csv(spark, folder, ["A", "B", "C"]).select("C")
    assert "ReadSchema: struct<C:string>" in plan._jdf.queryExecution().executedPlan().toString()


def test_missing_inputs(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        delimited.scan_csv(spark, str(tmp_path / "none"), ["A"])
    with pytest.raises(FileNotFoundError):
        delimited.scan_csv(spark, csv_folder(tmp_path, a=""), ["A"])
    with pytest.raises(ValueError, match="lacks columns: D"):
        (tmp_path / "in" / "a.csv").write_text("A,B\n1,2\n")
        delimited.scan_csv(spark, str(tmp_path / "in"), ["A", "D"])


def test_header_only_folder_has_no_rows(spark, tmp_path):
    assert delimited.scan_csv(spark, csv_folder(tmp_path, a="A,B\n"), ["A"]).count() == 0


def test_period_comes_from_the_path(spark, tmp_path):
    for month in (5, 6):
        folder = tmp_path / "year=2026" / f"month={month:02d}"
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text("Year,Month,X\n1999,1,a\n")
    everything = delimited.scan_flight_csv(spark, str(tmp_path), ["Year", "Month", "X"])
    assert rows_of(everything) == [("1999", "1", "a", 2026, 5), ("1999", "1", "a", 2026, 6)]
    june = delimited.scan_flight_csv(spark, str(tmp_path), ["Year", "X"], 2026, 6)
    assert rows_of(june) == [("1999", "a", 2026, 6)]
    with pytest.raises(FileNotFoundError):
        delimited.scan_flight_csv(spark, str(tmp_path), ["X"], 2026, 7)


def test_file_verdicts(spark, tmp_path):
    folder = csv_folder(
        tmp_path, good="A,B\n1,2\n", bom=b"\xef\xbb\xbfA,B\n1,2\n", empty="", header="A,B\n",
        wrong="A,C\n1,2\n", binary=b"A,B\n\xff\xfe\n", blank="\nA,B\n\n1,2\n",
    )
    verdicts = files.profile_files(spark, folder, ["A", "B"])
    found = {r.path.split("/")[-1].removesuffix(".csv"): r for r in verdicts.collect()}
    assert {k: r.verdict for k, r in found.items()} == {
        "good": "ok", "bom": "ok", "empty": "empty", "header": "no_rows", "wrong": "missing_columns",
        "binary": "undecodable", "blank": "ok",
    }
    assert found["wrong"].missing_columns == ["B"]
    with pytest.raises(files.UnusableFiles, match="empty.csv: empty") as error:
        files.require_good_files(verdicts)
    assert len(error.value.files) == 4
    files.require_good_files(verdicts.where("verdict = 'ok'"))


# ---- archives ---------------------------------------------------------------------------
def make_zip(path, **members):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, content in members.items():
            archive.writestr(name.replace("_", "."), content)


def test_archives(spark, tmp_path):
    make_zip(tmp_path / "a.zip", one_csv="A,B,C d,\r\n1,x,,\r\n2,\"y, z\",u,\r\n", two_csv="B,A\nq,3\n", note_txt="hi")
    make_zip(tmp_path / "b.zip", one_csv="﻿A,B\n" + "".join(f"{i},w\n" for i in range(50_000)))
    scan = delimited.scan_zipped_csv(spark, str(tmp_path), ["A", "B"])
    assert scan.count() == 50_003
    assert rows_of(scan.where("B <> 'w'")) == [("1", "x"), ("2", "y, z"), ("3", "q")]
    assert scan.where("B = 'w'").agg(F.count_distinct("A")).first()[0] == 50_000

    damage(tmp_path)
    verdicts = {
        r.path.split("/")[-1]: (r.members, r.verdict)
        for r in files.verify_archives(spark, str(tmp_path)).collect()
    }
    assert verdicts == {
        "a.zip": (3, "ok"), "b.zip": (1, "ok"), "none.zip": (0, "ok"), "empty.zip": (0, "empty"),
        "text.zip": (0, "not_zip"), "tiny.zip": (0, "not_zip"), "bad.zip": (1, "corrupt"),
    }


def damage(folder):
    """Archives that cannot be read, in four ways, next to ``b.zip``."""
    (folder / "empty.zip").write_bytes(b"")
    (folder / "text.zip").write_bytes(b"x" * 500)
    (folder / "tiny.zip").write_bytes(b"x")
    make_zip(folder / "none.zip")
    data = bytearray((folder / "b.zip").read_bytes())
    data[500] ^= 0xFF
    (folder / "bad.zip").write_bytes(bytes(data))


def test_bad_archives_are_reported_not_skipped(spark, tmp_path):
    make_zip(tmp_path / "b.zip", one_csv="A,B\n" + "".join(f"{i},w{i * 7919}\n" for i in range(5_000)))
    make_zip(tmp_path / "c.zip", one_csv="A,C\n1,2\n")
    damage(tmp_path)
    wanted = {"bad.zip": "corrupt", "c.zip": "missing_columns", "empty.zip": "empty", "text.zip": "not_zip", "tiny.zip": "not_zip"}
    with pytest.raises(files.UnusableFiles) as error:
        delimited.scan_zipped_csv(spark, str(tmp_path), ["A", "B"])
    assert {path.split("/")[-1]: verdict for path, verdict in error.value.files} == wanted
    bad = delimited.bad_archives(spark, str(tmp_path), ["A", "B"]).collect()
    assert {r.path.split("/")[-1]: r.problem for r in bad} == wanted
    assert delimited.scan_zipped_csv(spark, str(tmp_path), ["A", "B"], skip_bad=True).count() == 5_000


def test_archives_without_a_csv_member(spark, tmp_path):
    make_zip(tmp_path / "a.zip", note_txt="hi")
    with pytest.raises(FileNotFoundError):
        delimited.scan_zipped_csv(spark, str(tmp_path), ["A"])
    make_zip(tmp_path / "b.zip", one_csv="A\n")
    assert delimited.scan_zipped_csv(spark, str(tmp_path), ["A"]).count() == 0


def test_names_and_bytes_are_read_tolerantly(spark, tmp_path):
    (tmp_path / "UPPER.CSV").write_bytes(b" A ,B\n1,\xff\n")
    (tmp_path / "lower.csv").write_bytes(b"A,B\n2,x\n")
    scan = delimited.scan_csv(spark, str(tmp_path), ["A", "B"])
    assert rows_of(scan.select("A", "B")) == [("1", "\ufffd"), ("2", "x")]
    verdicts = {r.path.split("/")[-1]: r.verdict for r in files.profile_files(spark, str(tmp_path), ["A", "B"], files.CSV_PATTERN).collect()}
    assert verdicts == {"UPPER.CSV": "undecodable", "lower.csv": "ok"}
    with zipfile.ZipFile(tmp_path / "Z.ZIP", "w") as archive:
        archive.writestr("M.CSV", b"B, A\n\xfe,3\n")
    assert rows_of(delimited.scan_zipped_csv(spark, str(tmp_path), ["A", "B"])) == [("3", "\ufffd")]


def test_any_number_of_headers(spark, tmp_path):
    for i in range(60):
        (tmp_path / f"f {i}+.csv").write_text(",".join([*(f"x{k}" for k in range(i)), "A", f"y{i}"]) + "\n" + "," * i + f"{i},\n")
    assert sorted(int(r.A) for r in delimited.scan_csv(spark, str(tmp_path), ["A"]).collect()) == list(range(60))


def test_many_members_use_many_tasks(spark, tmp_path):
    for i in range(30):
        with zipfile.ZipFile(tmp_path / f"{i}.zip", "w") as archive:
            for k in range(10):
                archive.writestr(f"{k}.csv", f"A\n{i * 10 + k}\n")
    assert files.list_files(spark, str(tmp_path), files.ZIP_PATTERN).rdd.getNumPartitions() > 8
    rows = files.member_rows(files.listed_members(spark, str(tmp_path)), ["A"])
    tasks = rows.select(F.spark_partition_id().alias("task"), "A").collect()
    assert sorted(int(r.A) for r in tasks) == list(range(300)) and len({r.task for r in tasks}) > 8


# ---- period tables ----------------------------------------------------------------------
def monthly(spark, *rows):
    return spark.createDataFrame(rows, "v string, year int, month int")


def test_replace_period(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_periods(monthly(spark, ("a", 2026, 5), ("b", 2026, 6)), root)

    def content():
        return rows_of(spark.read.parquet(root).select("v", "year", "month"))

    # Rows of other months are not taken along.
    tables.replace_period(monthly(spark, ("c", 2026, 6), ("x", 2026, 5)), root, 2026, 6)
    assert content() == [("a", 2026, 5), ("c", 2026, 6)]
    tables.replace_period(monthly(spark, ("c", 2026, 6)), root, 2026, 6)
    assert content() == [("a", 2026, 5), ("c", 2026, 6)]
    # A month without rows becomes empty instead of keeping its old rows.
    tables.replace_period(monthly(spark, ("x", 2026, 5)).where("false"), root, 2026, 6)
    assert content() == [("a", 2026, 5)]
    tables.replace_period(monthly(spark, ("d", 2026, 6)), root, 2026, 6)
    assert content() == [("a", 2026, 5), ("d", 2026, 6)]


def test_scan_period_prunes_and_fails_when_missing(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        tables.scan_period(spark, root, 2026, 5)
    tables.write_periods(monthly(spark, ("a", 2026, 5), ("b", 2026, 6)), root)
    with pytest.raises(FileNotFoundError, match="2026-07"):
        tables.scan_period(spark, root, 2026, 7)
    june = tables.scan_period(spark, root, 2026, 6)
    assert rows_of(june.select("v")) == [("b",)]
    plan = june._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_zero_padded_months_are_found(spark, tmp_path):
    monthly(spark, ("a", 2026, 6)).drop("year", "month").write.parquet(f"{tmp_path}/year=2026/month=06")
    assert tables.scan_period(spark, str(tmp_path), 2026, 6).count() == 1
    # Writing gives a month one folder, whatever it was called before.
    tables.write_periods(monthly(spark, ("b", 2026, 6)), str(tmp_path))
    assert rows_of(tables.scan_period(spark, str(tmp_path), 2026, 6).select("v")) == [("b",)]
    monthly(spark, ("c", 2026, 6)).drop("year", "month").write.parquet(f"{tmp_path}/year=2026/month=06")
    tables.replace_period(monthly(spark, ("d", 2026, 6)), str(tmp_path), 2026, 6)
    assert rows_of(tables.scan_period(spark, str(tmp_path), 2026, 6).select("v")) == [("d",)]


def test_load_gold(spark, tmp_path):
    kpi = tables.evolve(
        monthly(spark, ("a", 2026, 5), ("b", 2026, 6), ("c", 2026, 7)), S.AIRLINE_KPI).drop("v")
    tables.write_periods(kpi, f"{tmp_path}/{S.KPI_TABLES['airlines']}")
    chosen = tables.load_gold(spark, str(tmp_path), "airlines", [(2026, 5), (2026, 7)])
    assert sorted(r.month for r in chosen.collect()) == [5, 7]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan
    assert tables.load_gold(spark, str(tmp_path), "airlines", []).count() == 0
    with pytest.raises(ValueError, match="no KPI dataset is called 'cities'"):
        tables.load_gold(spark, str(tmp_path), "cities", [(2026, 5)])


def test_ensure_table_never_loses_rows(spark, tmp_path):
    root = str(tmp_path / "t")
    assert tables.ensure_table(spark, root, S.AIRLINE_KPI).schema.names == S.AIRLINE_KPI.names
    kpi = tables.evolve(monthly(spark, ("a", 2026, 5)), S.AIRLINE_KPI).drop("v")
    tables.append_rows(kpi, root)
    table = tables.ensure_table(spark, root, S.AIRLINE_KPI)
    assert table.count() == 1 and table.schema.names == S.AIRLINE_KPI.names


def test_evolve(spark):
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.LongType())])
    df = tables.evolve(spark.createDataFrame([("x", 1)], "z string, a long"), schema)
    assert df.columns == ["a", "b", "z"] and df.first() == (1, None, "x")
    assert [f.dataType for f in df.schema.fields][:2] == [T.IntegerType(), T.LongType()]


def test_upsert(spark, tmp_path):
    path = str(tmp_path / "dim")

    def dim(*rows):
        return spark.createDataFrame(rows, S.DIM_AIRLINE)

    tables.merge_snapshot(spark, path, dim((1, "a", "A"), (2, "b", "B")), ["airline_id"])
    merged = tables.merge_snapshot(spark, path, dim((2, "new", None), (3, "c", "C")), ["airline_id"])
    expected = {(1, "a", "A"), (2, "new", None), (3, "c", "C")}
    assert {tuple(r) for r in merged.collect()} == expected

    def stored():
        return {tuple(r) for r in tables.read_snapshot(spark, path).collect()}

    with pytest.raises(ValueError, match="more than once"):
        tables.merge_snapshot(spark, path, dim((5, "x", "X"), (5, "y", "Y")), ["airline_id"])
    assert stored() == expected
    # A version that was not completed does not count, and is written anew.
    dim((9, "z", "Z")).write.parquet(f"{path}/version-000000000003")
    (tmp_path / "dim" / "version-000000000003" / "_SUCCESS").unlink()
    assert stored() == expected
    tables.merge_snapshot(spark, path, dim((1, "again", "A")), ["airline_id"])
    assert stored() == (expected - {(1, "a", "A")}) | {(1, "again", "A")}
    assert tables.read_snapshot(spark, str(tmp_path / "none")) is None


def test_surrogate_key(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    keyed = tables.with_surrogate_key(df, [F.col("k").desc()], "n", start=10)
    rows = {r.k: r.n for r in keyed.collect()}
    assert rows == {k: 10 + 999 - k for k in range(1000)}
    assert tables.with_surrogate_key(df.where("false"), ["k"], "n").count() == 0


def test_positions_do_not_depend_on_partitioning(spark):
    data = [(i % 3, i % 5, i) for i in range(300)] + [(None, 1, 1000 + i) for i in range(50)]
    for partitions in (1, 9):
        df = spark.createDataFrame(data, "g int, v int, id int").repartition(partitions)
        found = {(r.g, r.id): r.n for r in tables.with_positions(df, "g", [F.desc("v"), F.col("id")], "n").collect()}
        for group in (0, 1, 2, None):
            order = sorted((-v, i) for g, v, i in data if g == group)
            assert [found[group, i] for _, i in order] == list(range(1, len(order) + 1))


def test_period_keys_are_unique_without_a_shuffle(spark):
    df = spark.createDataFrame([(2026, m, i) for m in (5, 6) for i in range(100)], "year int, month int, v int").repartition(7)
    keyed = tables.with_period_key(df, "k")
    assert keyed.select("k").distinct().count() == 200
    ranges = keyed.groupBy("month").agg(F.min("k"), F.max("k")).orderBy("month").collect()
    assert 0 < ranges[0][1] and ranges[0][2] < ranges[1][1]
    assert keyed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # the test's own


def test_coordinates_of_loaded_kpis(spark, tmp_path):
    dim = spark.createDataFrame([(1, 10.0, 20.0)], "airport_id int, latitude double, longitude double")
    for dataset, ids in (("airports", {"airport_id": 1}), ("routes", {"origin_airport_id": 1, "dest_airport_id": 2})):
        rows = monthly(spark, ("a", 2026, 5)).withColumns({c: F.lit(v) for c, v in ids.items()})
        tables.write_periods(tables.evolve(rows, S.KPI_SCHEMAS[dataset]).drop("v"), f"{tmp_path}/{S.KPI_TABLES[dataset]}")
    row = tables.load_gold(spark, str(tmp_path), "airports", [(2026, 5)], dim).first()
    assert (row.latitude, row.longitude) == (10.0, 20.0)
    row = tables.load_gold(spark, str(tmp_path), "routes", [(2026, 5)], dim).first()
    assert (row.origin_latitude, row.dest_latitude) == (10.0, None)


def test_jdbc_append_passes_its_settings():
    calls = {}

    class Writer:
        def mode(self, value):
            calls["mode"] = value
            return self

        def option(self, name, value):
            calls[name] = value
            return self

        def jdbc(self, **arguments):
            calls.update(arguments)

    class Frame:
        write = Writer()

    tables.write_jdbc(Frame(), "jdbc:x", "t", {"user": "u"})
    assert calls == {"mode": "append", "batchsize": 10_000, "url": "jdbc:x", "table": "t",
                     "properties": {"user": "u"}}


def test_month_slice_reaches_the_scan(spark, tmp_path):
    from punctua.operators.periods import month_slice

    path = str(tmp_path / "f")
    spark.createDataFrame([(dt.date(2026, 6, 30),), (dt.date(2026, 7, 1),), (None,)], "d date").write.parquet(path)
    june = month_slice(spark.read.parquet(path), "d", 2026, 6)
    assert rows_of(june) == [(dt.date(2026, 6, 30),)]
    assert "GreaterThanOrEqual(d,2026-06-01)" in june._jdf.queryExecution().executedPlan().toString()


def test_scratch_paths_follow_the_session_setting(spark):
    base = spark.conf.get(storage.CHECKPOINT_SETTING)
    first, second = (storage.scratch_path(spark, "x") for _ in range(2))
    assert first != second and base in first


def test_scratch_is_emptied_also_on_failure(spark):
    with pytest.raises(RuntimeError):
        with storage.Scratch(spark) as scratch:
            held = scratch.staged(spark.range(3), "held")
            assert held.count() == 3
            raise RuntimeError
    assert not storage.has_data(spark, held.inputFiles()[0].rsplit("/", 1)[0])

"""Event files, maps, scans, quality gate, and the incremental cube."""

from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from starloom.operators import cubes, events, maps, quality
from starloom.sources import event_files, tables
from starloom.streaming import weekly


def test_event_files_round_trip_and_split(spark, sf_dir, tmp_path):
    photons, path = tables.scan_photons(spark, sf_dir), str(tmp_path / "files")
    event_files.write_events(photons.repartition(3), path)
    back = event_files.read_events(spark, path)
    assert back.dtypes == photons.dtypes
    assert sorted(back.collect()) == sorted(photons.collect())
    split = spark.read.format("event_files").option("split", 8000).load(path)
    assert split.rdd.getNumPartitions() >= 10 and split.count() == photons.count()
    assert event_files.read_events(spark, path, "energy_mev double").agg(F.sum("energy_mev")).first() == photons.agg(F.sum("energy_mev")).first()
    table = event_files.ingest_events(spark, path, str(tmp_path / "table"))
    assert table.where("week = 1").count() == photons.where("week = 1").count()


def write_table(path, fields, rows, extension="EVENTS", extra=(), cut=0):
    """A file with one binary table; ``fields`` are (name, form) pairs, ``rows`` its bytes."""
    width = len(rows[0]) if rows else 0
    cards = [(f"{a}{i}", f"'{v}'") for i, f in enumerate(fields, 1) for a, v in zip(("TTYPE", "TFORM"), f, strict=True)]
    head = [("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", str(width)), ("NAXIS2", str(len(rows))), ("PCOUNT", "0"), ("GCOUNT", "1"), ("TFIELDS", str(len(fields))), ("EXTNAME", f"'{extension}'"), *extra]
    data = b"".join(rows)
    table = event_files._cards(head + cards) + data + bytes(-len(data) % event_files.BLOCK)
    raw = path.read_bytes() if path.exists() else event_files._cards([("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0")])
    raw += table
    path.write_bytes(raw[: len(raw) - cut])


def test_bit_logical_scaled_null_and_many_valued_columns(spark, tmp_path):
    fields = [("ENERGY", "E"), ("EVENT_CLASS", "32X"), ("CALIB", "3I"), ("OK", "L"), ("SCALED", "I"), ("COUNT", "J"), ("UNSIGNED", "I"), ("NAME", "4A"), ("FAR", "1PD(5)")]
    rows = [
        struct.pack(">fI3hchih4s8s", 1.5, 128, 1, 2, 3, b"T", 10, 7, -32768, b"ab  ", b""),
        struct.pack(">fI3hchih4s8s", 2.5, 2**31 + 1, 4, 5, 6, b"\0", -4, -99, 32767, b"c\0\0\0", b""),
    ]
    (tmp_path / "files").mkdir()
    write_table(tmp_path / "files" / "w1.fits", fields, rows, extra=[("TSCAL5", "0.5"), ("TZERO5", "1.0"), ("TNULL6", "-99"), ("TZERO7", "32768")])
    found = event_files.read_events(spark, str(tmp_path / "files"))
    assert dict(found.dtypes) == {"energy": "float", "event_class": "bigint", "calib": "array<smallint>", "ok": "boolean", "scaled": "double", "count": "int", "unsigned": "bigint", "name": "string", "far": "array<double>"}
    assert [tuple(r) for r in found.orderBy("energy").collect()] == [(1.5, 128, [1, 2, 3], True, 6.0, 7, 0, "ab", []), (2.5, 2**31 + 1, [4, 5, 6], None, -1.0, None, 65535, "c", [])]
    assert events.event_mask(found.withColumn("event_type", F.lit(1)), class_mask=128).count() == 1


def test_another_table_of_the_same_file(spark, tmp_path):
    (tmp_path / "files").mkdir()
    file = tmp_path / "files" / "w1.fits"
    write_table(file, [("ENERGY", "D")], [struct.pack(">d", 5.0)])
    write_table(file, [("START", "D"), ("STOP", "D")], [struct.pack(">dd", 0.0, 9.0), struct.pack(">dd", 20.0, 30.0)], "GTI")
    assert [tuple(r) for r in event_files.read_events(spark, str(tmp_path / "files")).collect()] == [(5.0,)]
    assert sorted(map(tuple, event_files.read_events(spark, str(tmp_path / "files"), extension="GTI").collect())) == [(0.0, 9.0), (20.0, 30.0)]


def test_bad_files_are_reported_and_left_out(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    fields = [("ENERGY_MEV", "D"), ("WEEK", "J"), ("SOURCE_FILE", "2A")]
    rows = [struct.pack(">di2s", 5.0 + i, 1, b"w1") for i in range(400)]
    write_table(folder / "w1.fits", fields, rows)
    (folder / "w2.fits").write_bytes(b"no header at all")
    write_table(folder / "w3.fits", fields, rows, cut=2880)
    with pytest.raises(Exception, match="w3|cut|ends|header"):
        event_files.read_events(spark, str(folder), "energy_mev double").count()
    table = event_files.ingest_events(spark, str(folder), str(tmp_path / "table"))
    assert table.count() == 400
    report = event_files.check_files(spark, str(folder))
    assert {r["file"]: (r["n_rows"], r["error"] is None) for r in report.collect()} == {"w1": (400, True), "w2": (None, False), "w3": (None, False)}
    status = quality.file_status(report.withColumnRenamed("file", "source_file"), table, table, table)
    assert {r["source_file"]: r["status"] for r in status.collect()} == {"w1": "ok", "w2": "failed", "w3": "failed"}
    with pytest.raises(quality.GateError):
        quality.gate(status)


def test_layouts_that_differ_by_file(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    doubles = [struct.pack(">dh", 5.0 + i, i) for i in range(3)]
    write_table(folder / "w1.fits", [("TIME_S", "D"), ("N", "I")], doubles)
    write_table(folder / "w2.fits", [("N", "J"), ("T", "E"), ("MORE", "2A")], [struct.pack(">if2s", 70_000, 2.5, b"xx")])
    write_table(folder / "w3.fits", [("TIME_X", "D"), ("N", "I")], doubles)
    write_table(folder / "w4.fits", [("TIME_S", "1"), ("N", "I")], doubles)
    write_table(folder / "w5.fits", [("TIME_S", "2A"), ("N", "I")], [b"ab\0\1"])
    write_table(folder / "w6.fits", [("TIME_S", "D"), ("N", "I")], [], extra=[("NAXIS1", "10")])
    asked, other = "time_s double, n int", {"time_s": ["t"]}
    report = {r["file"]: r for r in event_files.check_files(spark, str(folder), columns=asked, aliases=other).collect()}
    assert {k: r["n_rows"] for k, r in report.items()} == {"w1": 3, "w2": 1, "w3": None, "w4": None, "w5": None, "w6": 0}
    assert "no column time_s" in report["w3"]["error"] and "form" in report["w4"]["error"] and "string" in report["w5"]["error"]
    assert report["w2"]["columns"] == {"time_s": "t float", "n": "n int"}
    read = lambda **how: event_files.read_events(spark, str(folder), asked, aliases=other, **how)
    wanted = [(2.5, 70_000), (5.0, 0), (6.0, 1), (7.0, 2)]
    assert sorted(map(tuple, read(skip_bad=True).collect())) == wanted
    assert event_files.read_events(spark, str(folder), "n int", skip_bad=True).count() == 8
    with pytest.raises(Exception, match="column"):
        read().count()
    rows = read(report=True)
    assert sorted(tuple(r)[:2] for r in rows.where("is_event").collect()) == wanted
    files = rows.where("NOT is_event")
    assert {r["file"]: r["error"] is None for r in files.collect()} == {"w1": True, "w2": True, "w3": False, "w4": False, "w5": False, "w6": True}
    assert files.where("time_s IS NOT NULL OR n IS NOT NULL").count() == 0
    # without asking, columns that all readable files have, of the widest type
    for name in ("w3", "w5"):
        (folder / f"{name}.fits").unlink()
    checked = event_files.check_files(spark, str(folder))
    assert event_files.common_columns(checked) == "`n` int"
    assert checked.where("error IS NOT NULL").count() == 1


def test_time_range_of_sorted_files_is_found_by_bisection(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "files")
    rows = spark.range(40_000).selectExpr("id", "id / 2.0D AS time_s", "concat('w', id div 20000) AS source_file", "sin(id) AS pad")
    event_files.write_events(rows, path, file_by="source_file", sorted_by="time_s")
    assert sorted(x.name for x in (tmp_path / "files").iterdir()) == ["w0.fits", "w1.fits"]
    found = event_files.read_events(spark, path, "id long, time_s double", between=("time_s", 9990.0, 10010.0))
    assert sorted(r["id"] for r in found.collect()) == list(range(19_980, 20_021))
    # bytes and rows that the reader itself touches
    read = []

    class Counting:
        def __init__(self, source):
            self.source = source

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.source.close()

        def read(self, n):
            read.append(n)
            return self.source.read(n)

        def __getattr__(self, name):
            return getattr(self.source, name)

    class Files:
        def open_input_file(self, name):
            return Counting(event_files.pafs.LocalFileSystem().open_input_file(name))

    schema = rows.select("id", "time_s").schema
    monkeypatch.setattr(event_files, "file_system", lambda p: (Files(), p))
    totals = []
    for filters in ([], [event_files.GreaterThan(("time_s",), 9990.0), event_files.LessThanOrEqual(("time_s",), 9991.0)]):
        reader = event_files.PushedReader({"path": path, "split": 200_000}, schema)
        assert list(reader.pushFilters(filters)) == filters
        read.clear()
        size = [x for name in ("w0", "w1") for i in range(0, 1_200_000, 200_000) for x in reader.read(event_files.Range(f"{path}/{name}.fits", i, i + 200_000))]
        totals.append((sum(read), sum(b.num_rows for b in size)))
    assert totals[0][1] == 40_000 and 1 <= totals[1][1] <= 4
    assert totals[1][0] < totals[0][0] / 10


def test_pushed_filters_of_a_session(spark, tmp_path):
    path = str(tmp_path / "files")
    event_files.write_events(spark.range(1000).selectExpr("id", "CAST(id AS DOUBLE) AS time_s").coalesce(1), path, sorted_by="time_s")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = event_files.read_events(spark, path).where("time_s >= 990 AND time_s < 995 AND id % 2 = 0")
        assert sorted(r["id"] for r in found.collect()) == [990, 992, 994]
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_columns_of_arrays(spark, tmp_path):
    (tmp_path / "files").mkdir()
    heap = struct.pack(">3d", 1.0, 2.0, 3.0) + b"hello" + struct.pack(">2h", 7, -8)
    fields = [("ID", "J"), ("FAR", "1PD(3)"), ("TEXT", "1QA(5)"), ("SCALED", "1PI(2)"), ("BITS", "1PX(4)")]
    rows = [struct.pack(">i2i2q2i2i", 1, 2, 0, 5, 24, 2, 29, 0, 0), struct.pack(">i2i2q2i2i", 2, 0, 0, 0, 0, 0, 0, 0, 0), struct.pack(">i2i2q2i2i", 3, 1, 16, 2, 27, 1, 31, 0, 0)]
    width = len(rows[0])
    table = event_files._cards([("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", str(width)), ("NAXIS2", "3"), ("PCOUNT", str(len(heap) + 4)), ("GCOUNT", "1"), ("THEAP", str(3 * width + 4)), ("TFIELDS", "5"), ("TSCAL4", "0.5"), *[(f"{a}{i}", f"'{v}'") for i, f in enumerate(fields, 1) for a, v in zip(("TTYPE", "TFORM"), f, strict=True)]])
    data = b"".join(rows) + b"\0" * 4 + heap
    (tmp_path / "files" / "w1.fits").write_bytes(event_files._cards([("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0")]) + table + data + bytes(-len(data) % event_files.BLOCK))
    found = event_files.read_events(spark, str(tmp_path / "files"))
    assert dict(found.dtypes) == {"id": "int", "far": "array<double>", "text": "string", "scaled": "array<double>"}
    assert [tuple(r) for r in found.orderBy("id").collect()] == [(1, [1.0, 2.0], "hello", [3.5, -4.0]), (2, [], "", []), (3, [3.0], "lo", [-4.0])]


def test_status_of_files_in_one_pass(spark, sf_dir, tmp_path):
    photons = tables.scan_photons(spark, sf_dir)
    gti = events.make_gti(events.quality(tables.scan_spacecraft(spark, sf_dir))).where("start_s < 1e6")
    event_files.write_events(photons, str(tmp_path / "files"), file_by="source_file", sorted_by="time_s")
    (tmp_path / "files" / "w9.fits").write_bytes((tmp_path / "files" / "w0.fits").read_bytes()[:9000])
    rows = event_files.read_events(spark, str(tmp_path / "files"), report=True)
    cut = F.col("energy_mev").between(1000, 10000)
    found = quality.reported_status(rows, cut, gti)
    selected = photons.where(cut)
    wanted = quality.file_status(photons.select("source_file").distinct(), photons, selected, events.filter_good_time(selected, gti))
    failed = ("w9", 0, 0, 0, "failed")
    assert sorted(map(tuple, found.select("source_file", "n_read", "n_selected", "n_good", "status").collect())) == sorted([*map(tuple, wanted.collect()), failed])
    assert {"ok", "empty"} <= {r["status"] for r in found.collect()}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("event_files") == 1


def test_writer_bounds_its_files_and_leaves_no_parts(spark, tmp_path, monkeypatch):
    path = tmp_path / "files"
    event_files.write_events(spark.range(300_000).repartition(1), str(path))
    names = sorted(x.name for x in path.iterdir())
    assert len(names) == 2 and all(x.endswith(".fits") for x in names)
    assert event_files.read_events(spark, str(path)).agg(F.sum("id"), F.count("*")).first()[:] == (299_999 * 150_000, 300_000)


def test_named_files_of_many_rows_stay_whole(spark, tmp_path):
    # 300,000 and 270,000 rows: more than a task may hold
    rows = spark.range(600_000).selectExpr("id", "id / 2.0D AS time_s", "CASE WHEN id < 300000 THEN 'w0' WHEN id < 570000 THEN 'w1' ELSE 'w2' END AS source_file").repartition(3)
    path = tmp_path / "files"
    event_files.write_events(rows, str(path), file_by="source_file", sorted_by="time_s")
    assert sorted(x.name for x in path.iterdir()) == ["w0.fits", "w1.fits", "w2.fits"]
    found = event_files.read_events(spark, str(path))
    assert found.exceptAll(rows).count() == 0 and found.count() == 600_000
    report = event_files.read_events(spark, str(path), "time_s double", report=True)
    status = quality.reported_status(report, F.col("time_s") >= 285_000, spark.createDataFrame([(0.0, 1e6)], "start_s double, stop_s double"))
    counts = [tuple(r) for r in status.orderBy("source_file").select("source_file", "n_read", "n_selected", "n_good", "status").collect()]
    assert counts == [("w0", 300_000, 0, 0, "empty"), ("w1", 270_000, 0, 0, "empty"), ("w2", 30_000, 30_000, 30_000, "ok")]


def test_time_range_prunes_weeks(spark, sf_dir, tmp_path):
    path = str(tmp_path / "photons")
    tables.scan_photons(spark, sf_dir).write.partitionBy("week").parquet(path)
    table = spark.read.parquet(path)
    found = events.time_range(table, 259200.0, 1728000.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week" in plan and "PushedFilters: [IsNotNull(time_s)" in plan
    assert found.count() == table.where("time_s BETWEEN 259200 AND 1728000").count()


def test_files_with_other_tables_before_the_events(spark, tmp_path):
    path = str(tmp_path / "files")
    event_files.write_events(spark.createDataFrame([(7, "ab")], "event_id long, source_file string"), path)
    name = next((tmp_path / "files").glob("*.fits"))
    raw = name.read_bytes()
    image = event_files._cards([("XTENSION", "'IMAGE   '"), ("BITPIX", "-32"), ("NAXIS", "1"), ("NAXIS1", "3")]) + bytes(event_files.BLOCK)
    name.write_bytes(raw[: event_files.BLOCK] + image + raw[event_files.BLOCK :])
    assert [tuple(r) for r in event_files.read_events(spark, path).collect()] == [(7, "ab")]


def test_no_files(spark, tmp_path):
    (tmp_path / "other.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        tables.scan_files(spark, str(tmp_path), "*.fits")
    assert tables.scan_files(spark, str(tmp_path), "*.txt").count() == 1


def test_map_is_overwritten_with_its_header(spark, tmp_path):
    path = str(tmp_path / "map")
    for value in (1.0, 2.0):
        tables.write_map(spark.createDataFrame([(0, 0, value)], "iy int, ix int, value double"), path, {"OBJECT": "sky"}, "made here")
    pixels, header = tables.read_map(spark, path)
    assert [r["value"] for r in pixels.collect()] == [2.0]
    assert sorted(map(tuple, header.collect())) == [("COMMENT", "", "made here"), ("OBJECT", "sky", "")]


def test_a_map_whose_writing_fails_stays_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "map")
    one = lambda value: spark.createDataFrame([(0, 0, value)], "iy int, ix int, value double")
    with pytest.raises(FileNotFoundError):
        tables.read_map(spark, path)
    tables.write_map(one(1.0), path, {"OBJECT": "sky"}, "first")
    # fails in the pixels, and between the pixels and the header
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|zero"):
        tables.write_map(one(0.0).withColumn("value", F.expr("1 / (ix * 1)")), path, {}, "second")
    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(type(spark), "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        tables.write_map(spark.range(1), path, {}, "third")
    pixels, header = tables.read_map(spark, path)
    assert [r["value"] for r in pixels.collect()] == [1.0] and ("COMMENT", "", "first") in [tuple(r) for r in header.collect()]
    for k in range(4):
        tables.write_map(one(float(k)), path)
        assert [r["value"] for r in tables.read_map(spark, path)[0].collect()] == [float(k)]
        # who began to read before can go on
        pixels.count() if k == 0 else None
    assert len(tables._versions(spark, path)) == 5


def test_maps_stored_by_pixel_meet_without_a_shuffle(spark, tmp_path):
    rows = spark.range(500).selectExpr("0 AS plane", "CAST(id DIV 25 AS INT) AS iy", "CAST(id % 25 AS INT) AS ix", "id AS counts", "CAST(id % 7 AS DOUBLE) AS exposure", "id / 3.0D AS value")
    parts = {c: tables.store_by_pixel(rows.select("plane", "iy", "ix", c), f"stored_{c}", str(tmp_path / c), buckets=4) for c in ("counts", "exposure")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found in (maps.intensity(parts["exposure"], parts["counts"]), maps.ratio_map(parts["counts"], parts["exposure"])):
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
            assert found.count() == 500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pointing_files(spark, sf_dir, tmp_path):
    path, rows = str(tmp_path / "files"), tables.scan_spacecraft(spark, sf_dir)
    tables.write_pointings(rows, path)
    back = tables.read_pointings(spark, path)
    assert back.dtypes == rows.dtypes and sorted(back.collect()) == sorted(rows.collect())
    assert tables.read_pointings(spark, path, (360000.0, 720000.0)).count() == rows.where("start_s BETWEEN 360000 AND 720000").count()
    # a file as other writers make it
    (tmp_path / "other").mkdir()
    fields = [("START", "D"), ("STOP", "D"), ("LIVETIME", "E"), ("DATA_QUAL", "I"), ("LAT_CONFIG", "B"), ("L_SCZ", "E"), ("B_SCZ", "E"), ("L_ZENITH", "E"), ("B_ZENITH", "E"), ("MODE", "2A")]
    write_table(tmp_path / "other" / "sc.fits", fields, [struct.pack(">ddfhBffff2s", 0.0, 30.0, 27.5, 1, 1, 10.0, -20.0, 30.0, 40.0, b"xx")], "SC_DATA")
    assert [tuple(r) for r in tables.read_pointings(spark, str(tmp_path / "other")).collect()] == [(0.0, 30.0, 27.5, 1, 1, 10.0, -20.0, 30.0, 40.0)]


def test_faults_of_pointings(spark):
    rows = spark.createDataFrame([(0.0, 10.0), (10.0, 20.0), (15.0, 18.0), (19.0, 40.0), (50.0, 60.0), (65.0, 61.0), (700_000.0, 700_010.0), (700_005.0, 700_006.0)], "start_s double, stop_s double")
    wanted = [(15.0, 18.0, "overlap", 3.0), (19.0, 40.0, "overlap", 1.0), (50.0, 60.0, "gap", 10.0), (65.0, 61.0, "backward", 4.0), (700_000.0, 700_010.0, "gap", 699_939.0), (700_005.0, 700_006.0, "overlap", 1.0)]
    for bucket in (20.0, 604800.0):
        assert sorted(map(tuple, events.pointing_faults(rows, bucket_s=bucket).collect())) == wanted
    assert events.pointing_faults(rows, 1000.0).where("fault = 'gap'").count() == 1


def status(spark, states):
    return spark.createDataFrame([(f"w{i}", s) for i, s in enumerate(states)], "source_file string, status string")


def test_gate_is_strict(spark):
    assert quality.gate(status(spark, ["failed", "failed", "ok", "empty"])).count() == 2
    with pytest.raises(quality.GateError):
        quality.gate(status(spark, ["failed", "failed", "failed", "ok"]))
    assert quality.gate(status(spark, [])).count() == 0


def test_status_of_each_file(spark):
    photons = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "source_file string, event_id long")
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    found = quality.file_status(listing, photons, photons, photons.where("event_id = 1"))
    assert sorted(map(tuple, found.collect())) == [("a", 2, 2, 1, "ok"), ("b", 1, 1, 0, "empty"), ("c", 0, 0, 0, "failed")]
    assert [r[0] for r in quality.missing_files(listing, photons).collect()] == ["c"]


def test_cube_from_a_stream_equals_the_batch(spark, sf_dir, tmp_path):
    photons, gti = tables.scan_photons(spark, sf_dir), events.make_gti(events.quality(tables.scan_spacecraft(spark, sf_dir)))
    files, folder, grid = str(tmp_path / "in"), str(tmp_path / "cube"), cubes.Blocks(10)
    for week in range(2):
        photons.where(F.col("week") == week).write.mode("append").parquet(files)
        stream = spark.readStream.schema(photons.schema).parquet(files)
        weekly.update_counts(stream, gti, grid, folder, str(tmp_path / "state")).awaitTermination(60)
    whole = cubes.counts_cube(events.filter_good_time(photons.where("week < 2"), gti), grid)
    assert sorted(weekly.counts(spark, folder).collect()) == sorted(whole.collect())

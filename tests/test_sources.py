"""Sources, sinks, SQL surface."""

from __future__ import annotations

import hashlib
import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from auditloom.plans import ingest, presets, query
from auditloom.sources import catalog, ranges, records, sinks, tabular, text


def test_views(spark, tmp_path):
    path = str(tmp_path / "my-table.parquet")
    spark.range(3).write.parquet(path)
    assert catalog.register(spark, path) == "my_table"
    with pytest.raises(ValueError):
        catalog.register(spark, path)
    assert catalog.register(spark, path, on_exists="keep") == "my_table"
    result = query.run(spark, "SELECT * FROM my_table WHERE id >= :low", limit=1, low=1)
    assert (result.columns, len(result.rows), result.truncated, result.total_rows) == (["id"], 1, True, 2)
    assert result.elapsed_ms > 0
    with pytest.raises(ValueError):
        query.run(spark, "SELECT 1", limit=query.MAX_LIMIT + 1)
    spark.catalog.dropTempView("my_table")


def test_detached_datasets(spark, tmp_path):
    path = str(tmp_path / "gis.parquet")
    spark.range(2).write.parquet(path)
    sets = catalog.Datasets(spark, {"gis_lots": path})
    assert sets.load("gis_lots").count() == 2 and sets.load("gis_lots").count() == 2
    assert sets.is_loaded("gis_lots")
    sets.unload("gis_lots")
    sets.unload("gis_lots")
    assert not spark.catalog.tableExists("gis_lots")
    with pytest.raises(KeyError):
        sets.load("none")


def test_wrapped_json_and_flatten(spark, tmp_path):
    path = tmp_path / "budget.json"
    path.write_text(json.dumps({"metadata": {"n": 2}, "records": [
        {"code": "069", "a": {"b": {"c": 1}, "d": "x"}, "items": [{"k": 1}], "tags": ["u"]},
        {"code": "043", "a": {"b": {"c": None}, "d": "y"}, "items": [], "tags": []}]}))
    rows = records.flatten(records.read_records(spark, str(path))).orderBy(F.desc("code")).collect()
    assert rows[0].asDict() == {"a_b_c": 1, "a_d": "x", "code": "069", "items": '[{"k":1}]', "tags": ["u"]}
    assert rows[1].a_b_c is None
    listed = tmp_path / "list.json"
    listed.write_text(json.dumps([{"x": 1}, {"x": 2}]))
    assert records.read_records(spark, str(listed)).count() == 2
    single = tmp_path / "single.json"
    single.write_text(json.dumps({"x": {"y": 1}}))
    assert records.read_records(spark, str(single)).count() == 1


WRAPPED = {
    "keyed": ({"meta": {"records": [{"no": 1}]}, "notes": [{"no": 2}], "records": "LIST", "more": [{"no": 3}]}, "LIST"),
    "top": ("LIST", "LIST"), "first_key_wins": ({"annual_data": "LIST", "data": [{"code": -1}]}, [{"code": -1}]),
    "single": ({"x": {"records": [{"y": 1}]}}, [{"x": {"records": [{"y": 1}]}}]), "empty": ({"records": []}, []), "plain": ({"records": [1, {"a": 2}, [{"b": 3}], None]}, [{"a": 2}]),
}


@pytest.mark.parametrize("size", [53, 997, 1 << 26])
@pytest.mark.parametrize("name", sorted(WRAPPED))
def test_elements_are_cut_at_any_range(spark, tmp_path, name, size):
    rng = random.Random(7)
    listed = [{"code": k, "t": "".join(rng.choice('ab"\\{}[],:é\n') for _ in range(rng.randint(0, 40))), "n": {"a": [1, {"b": k}]}} for k in range(60)]
    put = lambda v: json.loads(json.dumps(v).replace('"LIST"', json.dumps(listed)))
    value, want = map(put, WRAPPED[name])
    path = tmp_path / "w.json"
    path.write_text(json.dumps(value, indent=1 if size == 997 else None))
    found = records.elements(spark, str(path), size=size).orderBy("offset").collect()
    assert [json.loads(r.text) for r in found] == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "w.json"
    path.write_text(json.dumps({"records": [{"k": k, **({"x": 0.5} if k % 2 else {}), "d": {"e": [k]}} for k in range(500)]}))
    found = records.elements(spark, str(path), size=512)
    assert found.filter("size(split(text, 'k')) > 1").select(F.spark_partition_id()).distinct().count() > 1
    rows = records.split_records(spark, str(path), size=512)
    assert dict(rows.dtypes) == {"d": "struct<e:array<bigint>>", "k": "bigint", "x": "double"}
    assert rows.agg(F.sum("k"), F.count("x"), F.sum(F.col("d.e")[0])).first() == (124750, 250, 124750)
    assert records.split_records(spark, str(path), record_path="nothing").count() == 0


def test_features_with_different_properties(spark, tmp_path):
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.5, 2.0]}, "properties": {"NAME": "a", "tax": {"y": 1}}},
        {"type": "Feature", "geometry": None, "properties": {"NAME": "b", "acres": 2.5, "lots": [1, 2]}}, {"type": "Feature", "properties": {}}]}))
    rows = records.split_features(spark, str(path), size=64).collect()
    assert sorted((r.NAME or "", r.tax, r.acres, r.lots, r.geometry_type) for r in rows) == [
        ("", None, None, None, None), ("a", '{"y":1}', None, None, "Point"), ("b", None, 2.5, "[1,2]", None)]


def test_files_are_hashed_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ranges, "BLOCK", 1000)
    data = {"a/x.bin": b"0123456789" * 5000, "b/x.bin": b"", "c.txt": b"z"}
    for name, body in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    got = {r.file: (r.size, r.sha256) for r in sinks.contents(spark, str(tmp_path)).collect()}
    assert got == {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in data.items() if b}


def test_features(spark, tmp_path):
    path = tmp_path / "f.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]},
         "properties": {"NAME": "a", "tax": {"y": 1}}}]}))
    row = records.read_features(spark, str(path)).first()
    assert (row.geometry_type, json.loads(row.geometry_json)["coordinates"], row.NAME, row.tax) == (
        "Point", [1.0, 2.0], "a", '{"y":1}')


def test_coded_tsv(spark, tmp_path):
    header = ["LEAID", "V33", "TOTALREV"] + [f"C{i}" for i in range(9)]
    lines = ["\t".join(header), "\t".join(["51A", "100", "-2"] + ["0"] * 9), "\t".join(["51B", "M", "7"] + ["0"] * 7),
             "\t".join(["51C", "5", "6"])]
    path = tmp_path / "sdf.txt"
    path.write_text("\n".join(lines) + "\n")
    out = tabular.read_coded_tsv(spark, str(path)).orderBy("LEAID").collect()
    assert [(r.LEAID, r.enrollment, r.total_revenue, r.capital_outlay) for r in out] == [
        ("51A", 100.0, None, None), ("51B", None, 7.0, None)]
    assert out[0].source_file == "sdf.txt"


def test_each_tsv_file_has_its_own_header(spark, tmp_path):
    filler = [f"C{i}" for i in range(9)]
    for name, header, row in (("a.txt", ["LEAID", "V33", "TOTALREV"], ["1", "10", "999"]), ("b.txt", ["TOTALREV", "LEAID", "V33"], ["999", "2", "10"])):
        (tmp_path / name).write_text("\t".join(header + filler) + "\n" + "\t".join(row + ["0"] * 9) + "\n")
    out = tabular.read_coded_tsv(spark, str(tmp_path / "*.txt")).orderBy("LEAID").collect()
    assert [(r.LEAID, r.enrollment, r.total_revenue) for r in out] == [("1", 10.0, 999.0), ("2", 10.0, 999.0)]


def test_survey_headers_are_read_apart(spark, tmp_path):
    """No line is shuffled; blank first lines, quotes, a repeated header and a file without lines are plain cases."""
    filler = [f"C{i}" for i in range(9)]
    head = "\t".join(["LEAID", "V33", *filler])
    (tmp_path / "a b.txt").write_text("\n" + head + "\n" + "\t".join(['"1', "10"] + ["0"] * 9) + "\n" + head + "\n" + "\t".join(["2", "20"] + ["0"] * 9))
    (tmp_path / "blank.txt").write_text("\n\n")
    out = tabular.read_coded_tsv(spark, str(tmp_path / "*.txt"))
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert [(r.LEAID, r.enrollment) for r in out.collect()] == [('"1', 10.0), ("LEAID", None), ("2", 20.0)]


def test_family_written_by_bucket(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, row in (("enrollment_1.json", {"adm": 1}), ("enrollment_2.json", {"adm": 2, "code": "x"}), ("vdoe.json", {"per": 1.5}), ("rest.json", {"adm": 3})):
        (tmp_path / "in" / name).write_text(json.dumps(row))
    found = tabular.write_family(tabular.read_family(spark, str(tmp_path / "in" / "*.json")), str(tmp_path / "out"))
    assert {b: rows.columns for b, rows in found.items()} == {"enrollment": ["adm", "code", "source_file"], "vdoe": ["per", "source_file"]}
    assert sorted((r.adm, r.code) for r in found["enrollment"].collect()) == [(1, None), (2, "x")]
    assert "PartitionFilters: [isnotnull(bucket" in found["vdoe"]._jdf.queryExecution().executedPlan().toString()


def test_file_family(spark, tmp_path):
    for name in ("Enrollment_vdoe.json", "staffing.json", "apa_x.json", "other.json"):
        (tmp_path / name).write_text('{"v": 1}\n')
    rows = tabular.read_family(spark, str(tmp_path / "*.json")).collect()
    assert {r.source_file: r.bucket for r in rows} == {
        "Enrollment_vdoe.json": "enrollment", "staffing.json": "staffing", "apa_x.json": "apa", "other.json": None}


def test_cells(spark, tmp_path):
    path = str(tmp_path / "cells")
    spark.createDataFrame([("f", "s", 0, 0, "x")], tabular.CELL_SCHEMA).write.parquet(path)
    assert tabular.read_cells(spark, path).first().value == "x"


def test_sinks_and_checksums(spark, tmp_path):
    rows = spark.range(100).withColumn("year", F.col("id") % 2)
    sinks.write_parquet(rows, str(tmp_path / "p"), partition_by=["year"])
    sinks.write_json(rows, str(tmp_path / "j"))
    sinks.write_csv(rows.coalesce(1), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 100
    report = sinks.size_report(spark, str(tmp_path / "j"), str(tmp_path / "p")).first()
    assert report.source_bytes > 0 and report.target_bytes > 0 and report.times_smaller > 0
    for name, body in (("a.bin", b"one"), ("b.bin", b"two"), ("c.bin", b"three"), ("x/a.bin", b"one"), ("y/a.bin", b"two")):
        (tmp_path / "bin" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "bin" / name).write_bytes(body)
    manifest = spark.createDataFrame([
        ("a.bin", 3, hashlib.sha256(b"one").hexdigest().upper()), ("b.bin", 3, "00"), ("gone.bin", 1, "00"),
        ("x/a.bin", 3, hashlib.sha256(b"one").hexdigest()), ("y/a.bin", 3, hashlib.sha256(b"two").hexdigest())],
        "file string, size long, sha256 string")
    out = sinks.verify(sinks.contents(spark, str(tmp_path / "bin")), manifest).collect()
    assert {r.file: r.state for r in out} == {
        "a.bin": "ok", "b.bin": "changed", "c.bin": "unlisted", "gone.bin": "missing", "x/a.bin": "ok", "y/a.bin": "ok"}


BOOK = """COUNTY OF ALPHA 2024
PAGE 1
43-   -19- 63
SMITH, JOHN
12 MAIN ST
WINCHESTER VA 22601
LOT 7B RED BUD
10 381,600 924,300 1,305,900 6,268.32 ACCT- 1234
12.5 AC CL 2 ZN RA
FH 3,134.16 SH 3,134.16
5,000 DEFERRED
DATE: 1/1/2024
44A- -A - 1
DOE JANE
PO BOX A
100,000 100,000 610.00 ACCT- 99
CL 1 ZN RP
CLASS 2 TOTALS 1
45-1-2
NO VALUES HERE
"""


def test_tax_book_from_text_blocks(spark, tmp_path):
    path = tmp_path / "book_2024.txt"
    path.write_text(BOOK)
    rows = {r.parcel_code: r for r in ingest.tax_books(spark, str(path)).collect()}
    assert sorted(rows) == ["43--19-63", "44A--A-1"]
    a, b = rows["43--19-63"], rows["44A--A-1"]
    assert (a.year, a.owner_name, a.owner_address, a.owner_city_state_zip) == (
        2024, "SMITH, JOHN", "12 MAIN ST", "WINCHESTER VA 22601")
    assert (a.land_value, a.improvement_value, a.total_value, float(a.tax_amount)) == (381600, 924300, 1305900, 6268.32)
    assert (a.acreage, a.property_class, a.zone, a.account_number, a.district) == (12.5, 2, "RA", "1234", "Red Bud")
    assert (float(a.first_half_tax), a.deferred_value, a.description) == (3134.16, 5000, "LOT 7B")
    assert (b.land_value, b.improvement_value, b.total_value, b.deferred_value) == (100000, 0, 100000, 0)


def test_records_cross_file_blocks(spark, tmp_path):
    """The same records come out however small the blocks of the file are."""
    path = tmp_path / "book_2023.txt"
    path.write_text("".join(f"{i}- -{i}- 1\nOWNER {i}\nADDR\n{i},000 0 {i},000 5.00 ACCT- {i}\n" for i in range(1, 400)))
    whole = ingest.tax_books(spark, str(path)).select("account_number", "owner_name", "total_value")
    expected = sorted(map(tuple, whole.collect()))
    assert len(expected) == 399
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = text.read_lines(spark, str(path))
        assert lines.select("block").distinct().count() > 5
        small = ingest.tax_books(spark, str(path)).select("account_number", "owner_name", "total_value")
        assert sorted(map(tuple, small.collect())) == expected
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_presets(spark):
    assert len(presets.names()) == 15 and len(presets.names("schools")) == 5
    spark.createDataFrame([("A", "2023-24", 5, 1, 2), ("B", "2023-24", 9, 1, 2), ("B", "2022-23", 7, 1, 2)],
                          "division_name string, fiscal_year string, metrics_total_per_pupil int, "
                          "metrics_local_per_pupil int, metrics_state_per_pupil int"
                          ).createOrReplaceTempView("vdoe_table15_expenditures")
    rows = presets.run_preset(spark, "School Spending Comparison").collect()
    assert [(r["District"], r["$/Student"]) for r in rows] == [("B", 9), ("A", 5)]
    spark.createDataFrame([("FY1", "total", 1e6, 2e6), ("FY1", "x", 3e6, None), ("FY1", "y", 4e6, 0.0)],
                          "fiscal_year string, category string, adopted double, prior_actual double"
                          ).createOrReplaceTempView("county_govt_budget_detail")
    rows = presets.run_preset(spark, "Budget by Category").collect()
    assert [tuple(r) for r in rows] == [("FY1", "y", 4.0, 0.0), ("FY1", "x", 3.0, None)]
    for view, column, values in (("vdoe_table8_enrollment", "metrics_adm_total", [10, 20]),
                                 ("vdoe_table17_ratios", "metrics_pupil_teacher_ratio_k7", [1, 2])):
        spark.createDataFrame([("A", "2023-24", values[0]), ("B", "2023-24", values[1])],
                              f"division_name string, fiscal_year string, {column} int").createOrReplaceTempView(view)
    rows = presets.run_preset(spark, "Peer District Comparison", peers=["A", "B"]).collect()
    assert [tuple(r) for r in rows] == [("B", 20, 9, 2), ("A", 10, 5, 1)]
    owners = json.dumps([{"owner": f"o{i}", "total_value": i, "properties": 1, "entity_type": "LLC"} for i in range(30)])
    spark.createDataFrame([(2024, owners), (2023, "[]")], "year int, top_owners_by_value string"
                          ).createOrReplaceTempView("ownership_analysis")
    rows = presets.run_preset(spark, "Top Property Owners").collect()
    assert (len(rows), rows[0]["Owner"], rows[-1]["Owner"]) == (25, "o24", "o0")


def test_small_ranges_share_tasks(spark, tmp_path):
    path = tmp_path / "w.json"
    listed = [{"k": k, "t": '\\" {[' * (k % 5)} for k in range(2000)]
    path.write_text(json.dumps({"notes": [{"k": -1}], "records": listed}))
    found = records.elements(spark, str(path), size=64)
    assert [json.loads(r.text) for r in found.orderBy("offset").collect()] == listed
    assert found.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism


def test_files_of_wrapped_rows_hold_a_bounded_number(spark, tmp_path, monkeypatch):
    from auditloom.workload import source
    monkeypatch.setattr(source, "_FILE_ROWS", 100, raising=False)
    rows = spark.range(1000).select("id", F.to_json(F.struct("id")).alias("json"))
    folder = source._wrapped(SimpleNamespace(spark=spark), rows, "features", 3, '{"type": "FeatureCollection", ', "}", "features")
    files = spark.read.text(folder).groupBy(F.input_file_name()).agg(F.sum(F.col("value").startswith('{"id"').cast("int")).alias("n"))
    assert files.agg(F.count(F.lit(1)), F.sum("n")).first() == (12, 1000) and files.agg(F.max("n")).first()[0] <= 100
    found = records.elements(spark, folder, "features").select(F.get_json_object("text", "$.id").cast("bigint").alias("id"))
    assert sorted(r.id for r in found.collect()) == list(range(1000))

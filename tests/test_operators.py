"""Operators on in-line rows: nulls, zeros, ties, gaps; committed figures as goldens."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import extract as X, frames as V, joins as J, networks as G, quality as Q, rank as W
from auditloom.operators import rollups as R, trends as T
from auditloom.plans import audit, ownership


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- goldens: published figures of a five-year audit ------------------------------

@pytest.mark.parametrize("first, last, growth, cagr", [
    (13736.0, 14121.0, 2.8, 0.69), (13091.0, 15734.0, 20.19, 4.7)])
def test_growth_goldens(spark, first, last, growth, cagr):
    rows = spark.createDataFrame([("069", 0, first), ("069", 2, None), ("069", 4, last)], "d string, i int, v double")
    out = T.growth_nonnull(rows, ["d"], "i", "v").first()
    assert (out.periods, out.total_growth_pct, out.cagr_pct) == (4, growth, cagr)


def test_budget_growth_and_decline_goldens(spark):
    rows = spark.createDataFrame([("x", "FY2020", 343449409.0, 60.8), ("x", "FY2025", 492899936.0, 57.02)],
                                 "d string, y string, v double, share double")
    assert T.growth_positions(rows, ["d"], "y", "v").first().growth_pct == 43.51
    flag = Q.decline_flags(rows, ["d"], "y", "share").first()
    assert (flag.value, flag.threshold, flag.severity) == (57.02, 60.8, "INFO")


def test_survey_metrics_guards(spark):
    row = (100, 1000.0, 600.0, 30.0, 20.0)
    rows = spark.createDataFrame([row, (0, 1000.0, 600.0, 30.0, 20.0), (100, 0.0, None, 30.0, 0.0)],
                                 "enrollment int, total_expenditures double, instruction_expenditures double, "
                                 "general_administration double, school_administration double")
    a, b, c = T.survey_metrics(rows).collect()
    assert (a.per_pupil_total, a.admin_pct, a.per_pupil_admin, a.instruction_pct) == (10.0, 5.0, 0.5, 60.0)
    assert (b.per_pupil_total, b.admin_pct, b.per_pupil_admin) == (None, 5.0, None)
    assert (c.total_administration, c.instruction_pct) == (None, None)


# --- rank ----------------------------------------------------------------------------

def test_global_rank_is_a_permutation_with_a_hot_value(spark):
    random.seed(1)
    data = [(i, 5.0 if i % 3 else random.random() * 10) for i in range(3000)]
    rows = spark.createDataFrame(data, "k int, v double")
    got = {k: n for k, n in rows_of(W.global_rank(rows, [F.col("v").desc(), F.col("k")], partitions=7).select("k", "rank"))}
    expected = {k: i for i, (k, _) in enumerate(sorted(data, key=lambda r: (-r[1], r[0])), 1)}
    assert got == expected


@pytest.mark.parametrize("n", [1, 3, 4, 10, 11])
def test_global_quartile_is_ntile(spark, n):
    rows = spark.createDataFrame([(i, float(n - i)) for i in range(n)], "k int, v double")
    a = rows_of(W.global_quartile(rows, "v", "k").select("k", "quartile"), "k")
    b = rows_of(W.quartile(rows, "v", "k").select("k", "quartile"), "k")
    assert a == b


def test_running_id_does_not_depend_on_chunks(spark):
    random.seed(2)
    flags = [random.random() < 0.2 for _ in range(500)]
    rows = spark.createDataFrame([("f", i, s) for i, s in enumerate(flags)], "f string, i int, s boolean")
    expected, n = [], 0
    for i, s in enumerate(flags):
        n += s
        expected.append((i, n))
    for size in (1, 7, 10_000):
        out = W.running_id(rows, ["f"], F.floor(F.col("i") / size), ["i"], F.col("s"))
        assert rows_of(out.select("i", "record_id"), "i") == expected


def test_limit_then_threshold_and_ties(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, n int")
    order = [F.col("n").desc(), F.col("k")]
    assert rows_of(W.limit_then_threshold(rows, order, 3, F.col("n") > 5)) == [("b", 9)]
    assert [r[0] for r in rows_of(W.top_k(rows, order, 2))] == ["b", "a"]


def test_latest_year_matrix_keeps_entities_without_the_year(spark):
    rows = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 7.0), ("b", 1, 4.0), ("c", 2, 0.0)], "e string, y int, v double")
    assert rows_of(W.latest_year_matrix(rows, ["e"], "y", ["v"]), "e") == [
        ("Peer Average", 7.0), ("a", 7.0), ("b", None), ("c", 0.0)]


# --- rollups ----------------------------------------------------------------------------

def test_blank_owner_counts_as_individual_but_is_no_owner(spark):
    rows = spark.createDataFrame([("", 10.0, "Individual"), ("x", 5.0, "LLC"), ("x", 5.0, "LLC")],
                                 "owner string, total_value double, entity_type string")
    assert rows_of(R.entity_breakdown(rows), "entity_type") == [
        ("Individual", 1, 10.0, 33.3, 50.0), ("LLC", 2, 10.0, 66.7, 50.0)]
    assert rows_of(R.owner_rollup(rows)) == [("x", 10.0, 2)]


def test_zero_totals_give_zero_shares(spark):
    rows = spark.createDataFrame([("a", 0.0), (None, 0.0)], "district string, total_value double")
    out = R.district_rollup(rows, measures=["total_value"], acreage=None)
    assert rows_of(out, "district") == [("Unknown", 1, 0.0, 0.0, 0.0), ("a", 1, 0.0, 0.0, 0.0)]


def test_small_and_large_share_agree(spark):
    rows = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("s"), F.col("id").alias("v"))
    rollup = rows.groupBy("s", "k").agg(F.sum("v").alias("v"))
    for scope in ((), ("s",)):
        a = R.with_share(rollup, "v", "p", scope)
        b = R.with_share(rollup, "v", "p", scope, small=False)
        assert rows_of(a.select("s", "k", "p"), "s", "k") == rows_of(b.select("s", "k", "p"), "s", "k")


def test_money_sums_are_exact(spark):
    rows = spark.createDataFrame([("a", 0.1)] * 1000 + [("a", 1e11)], "k string, v double")
    assert rows_of(rows.groupBy("k").agg(R.value_sum("v").alias("s"))) == [("a", 100000000100.0)]


def test_networks_match_brute_force_with_a_hot_address(spark):
    random.seed(3)
    data = []
    for i in range(1500):
        hot = i % 3 == 0
        addr = "1 HOT STREET" if hot else f"{random.randrange(60)} SIDE ROAD"
        data.append((f"p{i:05d}", f"LLC {random.randrange(40 if hot else 90)}", addr, float(random.randrange(1000))))
    rows = spark.createDataFrame(data, "parcel string, owner string, address string, total_value double")
    got = G.top_networks(rows, "address", "owner", "parcel", entity=None).collect()
    groups = {}
    for _, owner, addr, value in data:
        groups.setdefault(addr, {}).setdefault(owner, []).append(value)
    expected = sorted(((a, len(o), sum(map(sum, o.values()))) for a, o in groups.items() if len(o) >= 3),
                      key=lambda x: (-x[2], x[0]))[:50]
    assert [(r.address, r.name_count, r.total_value) for r in got] == expected
    best = sorted(groups["1 HOT STREET"].items(), key=lambda kv: (-sum(kv[1]), kv[0]))[:15]
    assert [n.name for n in next(r for r in got if r.address == "1 HOT STREET").names] == [n for n, _ in best]


# --- joins ----------------------------------------------------------------------------------

def test_blank_keys(spark):
    parcels = spark.createDataFrame([(1, 10.0), (2, 0.0), (3, None)], "id int, macct double")
    taxes = spark.createDataFrame([(2024, 10.0, "a"), (2024, None, "b"), (2024, None, "c"), (2023, 10.0, "old")],
                                  "year int, account_number double, owner string")
    strict = J.account_join(parcels, taxes, "macct", "account_number", ["owner"])
    assert rows_of(strict.select("id", "owner"), "id") == [(1, "a"), (2, None), (3, None)]
    report = J.account_match_report(parcels, taxes.filter("year = 2024"), "macct", "account_number").first()
    assert tuple(report) == (3, 3, 1, 5, 5)


def test_long_accounts_and_blank_parcels(spark):
    parcels = spark.createDataFrame([(1, "9007199254740993"), (2, "NaN"), (3, "1234567890123456789.0"), (4, "")], "id int, macct string")
    taxes = spark.createDataFrame([(2024, "9007199254740992", "no"), (2024, "1234567890123456789", "yes"), (2024, "NaN", "no")],
                                  "year int, account_number string, owner string")
    got = J.account_join(parcels, taxes, "macct", "account_number", ["owner"])
    assert rows_of(got.select("id", "owner"), "id") == [(1, None), (2, None), (3, "yes"), (4, None)]
    plots = spark.createDataFrame([(1, None), (2, " "), (3, "4 A"), (4, "")], "id int, pin string")
    codes = spark.createDataFrame([(2024, "", 7), (2024, " ", 8), (2024, None, 9), (2024, "4--A", 1)], "year int, code string, v int")
    got = J.parcel_join(plots, codes, "pin", "code", ["v"])
    assert rows_of(got.select("id", "v"), "id") == [(1, None), (2, None), (3, 1), (4, None)]


def test_zero_total_keeps_the_improvement(spark):
    lines = ["12- -1- 3", "OWNER", "5,000 20,000 0 0.00 ACCT- 7"]
    rows = spark.createDataFrame([("b", 1, lines, " ".join(lines))], "path string, record_id long, lines array<string>, text string")
    out = X.property_records(rows, ["path"]).first()
    assert (out.land_value, out.improvement_value, out.total_value) == (20000, 20000, 0)


def test_densify_and_series(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("a", 3, None), ("b", 2, 7)], "e string, y int, v int")
    assert rows_of(J.densify(rows, ["e"], "y", [1, 2, 3], ["v"], fill=0), "e", "y") == [
        ("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 7), ("b", 3, 0)]
    own = T.series(T.own_year_trend(rows, ["e"], "y", ["v"]), ["e"], "y", ["v"])
    assert rows_of(own) == [("a", [1, 3], [5, 0])]


def test_growth_variants(spark):
    rows = spark.createDataFrame([("z", 1, 0.0), ("z", 2, 5.0), ("g", 1, 10.0), ("g", 2, 12.0), ("g", 3, 0.0),
                                  ("s", 1, 4.0)], "e string, y int, v double")
    assert rows_of(T.growth_positions(rows, ["e"], "y", "v").select("e", "growth_pct"), "e") == [
        ("g", -100.0), ("s", None), ("z", None)]
    assert rows_of(T.growth_positions(rows, ["e"], "y", "v", last_nonzero=True).select("e", "growth_pct"), "e") == [
        ("g", 20.0), ("s", None), ("z", None)]


# --- quality -------------------------------------------------------------------------------

def test_tiers_and_messages(spark):
    rows = spark.createDataFrame([("a", 12.0, 50.0, 100.0, 1300.0), ("b", 7.0, 62.0, 200.0, 10.0),
                                  ("c", None, 0.0, 0.0, None), ("d", 5.0, 65.0, 250.0, 1200.0)],
                                 "k string, administration_pct double, instruction_pct double, "
                                 "admin_to_student double, per_pupil_admin double")
    out = Q.tiered_flags(rows, ["k"])
    assert rows_of(out.select("k", "indicator", "severity"), "k", "indicator") == [
        ("a", "admin_ratio", "high"), ("a", "admin_to_student", "high"), ("a", "instruction_ratio", "high"),
        ("a", "per_pupil_admin", "medium"), ("b", "admin_ratio", "medium"), ("b", "admin_to_student", "medium"),
        ("b", "instruction_ratio", "medium")]
    assert out.filter("k = 'a' and indicator = 'admin_ratio'").first().message == (
        "Administrative spending ratio (12.0%) exceeds 10.0% threshold")


def test_anomalies_with_nulls(spark):
    rows = spark.createDataFrame([("p1", None, 60.0, 50_000.0), ("p2", 6, 60.0, 50_000.0), ("p3", 2, None, 50_000.0)],
                                 "parcel string, property_class int, acreage double, total_value double")
    assert [r.parcel for r in Q.large_lot_low_value(rows).collect()] == ["p1"]


# --- extraction -----------------------------------------------------------------------------

def test_strict_records_take_the_first_consistent_block(spark):
    lines = ["12- -1- 3", "OWNER", "10 20 9,999 1.00 100,000 50,000 150,000 900.00 ACCT- 7"]
    rows = spark.createDataFrame([("b", 1, lines, " ".join(lines))], "path string, record_id long, lines array<string>, text string")
    out = X.property_records_strict(rows, ["path"]).first()
    assert (out.land_value, out.improvement_value, out.total_value, float(out.tax_amount)) == (100000, 50000, 150000, 900.0)
    loose = X.property_records(rows, ["path"]).first()
    assert (loose.total_value, float(loose.tax_amount)) == (150000, 900.0)


def test_values_over_the_caps_fall_back_to_land_only(spark):
    lines = ["12- -1- 3", "OWNER", "1 2 60,000,000 5.00 ACCT- 7"]
    rows = spark.createDataFrame([("b", 1, lines, " ".join(lines))], "path string, record_id long, lines array<string>, text string")
    assert X.property_records(rows, ["path"]).count() == 0
    lines[2] = "60,000,000 1,000 2,000 5.00 ACCT- 7"
    rows = spark.createDataFrame([("b", 1, lines, " ".join(lines))], "path string, record_id long, lines array<string>, text string")
    out = X.property_records(rows, ["path"]).first()
    assert (out.land_value, out.improvement_value, out.total_value) == (60000000, 1000, 2000)


def test_page_fields(spark):
    html = ("<th>Total Students:</th> <td x>14,121</td><th>Librarians/Media Specialists:</th> <td>20.5.</td>"
            "<td>Federal:</font></td> <td a><font b>$1,234</font></td>")
    out = X.html_fields(spark.createDataFrame([(1, html)], "id int, html string"), "html", ["id"]).first()
    assert (out.enrollment, out.staff_breakdown.librarians, out.revenue.federal_revenue, out.per_pupil.total_revenue_pp) == (
        14121, 20.5, 1234, None)


def test_grid_without_key_header_uses_the_first_column(spark):
    data = [("f", "s", 0, 0, "Code "), ("f", "s", 0, 1, "Total ADM"), ("f", "s", 0, 2, None),
            ("f", "s", 1, 0, "069"), ("f", "s", 1, 1, "$1,000"), ("f", "s", 2, 0, "111"), ("f", "s", 2, 1, None),
            ("f", "t", 0, 0, "nothing here"), ("f", "t", 1, 0, "069")]
    cells = spark.createDataFrame(data, "file string, sheet string, row_idx int, col_idx int, value string")
    out = X.promote_header(cells, ["file", "sheet"], "enrollment")
    assert rows_of(out.select("sheet", "key", "adm_total"), "key") == [("s", "069", 1000.0), ("s", "111", 0.0)]
    one = X.promote_header(cells, ["file", "sheet"], "enrollment", {"069": "alpha"})
    assert rows_of(one.select("key")) == [("069",)]


def test_row_categories_last_total_wins(spark):
    rows = spark.createDataFrame([("t", 0, "Instruction", [5.0, -9.0]), ("t", 1, "Total all", [70.0]), ("t", 2, "Grand total", [80.0]),
                                  ("t", 3, "misc", [2000.0]), ("t", 4, "misc", [10.0]), ("u", 0, "bus", [3.0]), ("u", 1, "x", [-1.0])],
                                 "t string, i int, s string, a array<double>")
    out = X.row_categories(rows, ["t"], "i", "s", "a").orderBy("t").collect()
    assert [(r.instruction, r.pupil_transportation, r.other, r.total) for r in out] == [(5.0, 0.0, 2000.0, 80.0), (0.0, 3.0, 0.0, 13.0 - 10.0)]


# --- frames ---------------------------------------------------------------------------------

def test_quantile_breaks_brute_force(spark):
    random.seed(4)
    values = [7.0 if random.random() < 0.4 else round(random.random() * 20, 1) for _ in range(997)]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "v double")
    for classes in (1, 3, 5):
        step, ordered = len(values) / classes, sorted(values)
        expected = [ordered[0]] + [ordered[math.floor(step * i)] for i in range(1, classes)] + [ordered[-1]]
        assert [e for _, e in rows_of(V.quantile_breaks(rows, "v", classes), "idx")] == expected


def test_classes_and_nulls(spark):
    rows = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0), (4, None), (5, 99.0)], "k int, v double")
    edges = spark.createDataFrame([(0, 0.0), (1, 5.0), (2, 10.0)], "idx long, edge double")
    assert rows_of(V.assign_classes(rows, "v", edges).select("k", "class"), "k") == [(1, 0), (2, 0), (3, 1), (4, None), (5, 1)]


def test_series_frame_defaults(spark):
    rows = spark.createDataFrame([(None, None, math.nan), ("a", "7", 2.0)], "l string, x string, y double")
    assert rows_of(V.series_frame(rows), "label") == [("", 0.0, 0.0), ("a", 7.0, 2.0)]


# --- pipelines ------------------------------------------------------------------------------

def test_ownership_pipeline(spark, tmp_path):
    data = []
    for year in (2023, 2024):
        for i in range(60):
            name = (f"SMITH{i % 4}, ANN", "ACME LLC", "BETA LLC", "GAMMA LLC", "OAK CHURCH")[i % 5]
            data.append((year, f"{year}-{i:03d}", name, "PO BOX 12", "X TOWN WV 25413" if i % 2 else "WINCHESTER VA 22601",
                         i % 3 or None, ("Red Bud", "Shawnee", None)[i % 3], "RA", 100.0 * i, 10.0 * i, 110.0 * i * (year - 2022), 2.0))
    records = spark.createDataFrame(data, "year int, parcel_code string, owner_name string, owner_address string, "
                                    "owner_city_state_zip string, property_class int, district string, zone string, land_value double, "
                                    "improvement_value double, total_value double, acreage double")
    path = str(tmp_path / "silver")
    ownership.write_silver(records, path)
    rows = ownership.read_silver(spark, path)
    yearly = ownership.yearly_tables(rows)
    for name, table in {**yearly, **ownership.latest_tables(rows)}.items():
        assert table.collect() is not None, name
    summary = yearly["summary"].orderBy("year").collect()
    assert [(r.year, r.total_records, r.unique_llcs, r.total_llc_records) for r in summary] == [(2023, 60, 3, 36), (2024, 60, 3, 36)]
    networks = ownership.latest_tables(rows)["llc_networks"].collect()
    assert [(r.address, r.name_count) for r in networks] == [("PO BOX 12", 3)]
    multi = ownership.multi_year_tables(yearly["summary"], yearly["entity_breakdown"], [2023, 2024])
    growth = {r.measure: r.growth_pct for r in multi["growth"].collect()}
    assert growth["total_value"] == 100.0 and growth["unique_llcs"] == 0.0
    assert multi["year_over_year"].first().total_value_change_pct == 100.0
    assert sum(r.pct_records for r in yearly["entity_breakdown"].filter("year = 2024").collect()) == pytest.approx(100, abs=0.5)
    features = spark.createDataFrame([("Red Bud district",), ("Elsewhere",)], "NAME string")
    enriched = {r.NAME: r.ownership for r in ownership.enrich_districts(features, yearly["district_profile"]).collect()}
    assert sorted(enriched["Red Bud district"].years) == ["2023", "2024"] and enriched["Elsewhere"] is None


def test_audit_pipeline(spark):
    years = ["2019-20", "2020-21", "2021-22", "2022-23", "2023-24"]
    enrol = spark.createDataFrame([("069", y, 13736.0 + i * 96.25) for i, y in enumerate(years)] + [("043", "2023-24", 1800.0)],
                                  "division_code string, fiscal_year string, adm double")
    admin = spark.createDataFrame([("069", f"FY{2020 + i}", 40.0 + 4 * i, 300.0) for i in range(5)] + [("043", "FY2024", 5.0, 60.0)],
                                  "division_code string, fiscal_year string, admin_positions double, support_total double")
    taught = spark.createDataFrame([(d, f"FY{2020 + i}", 1000.0, 1200.0) for i in range(5) for d in ("069", "043")],
                                   "division_code string, fiscal_year string, teachers double, instructional double")
    spend = spark.createDataFrame([("069", "2023-24", 15734, 7379, 5979, 960), ("043", "2023-24", 15000, 1, 1, 1),
                                   ("STATE", "2023-24", 16000, 1, 1, 1)],
                                  "division_code string, fiscal_year string, total_per_pupil int, local_per_pupil int, "
                                  "state_per_pupil int, federal_per_pupil int")
    budget = spark.createDataFrame([("069", "FY2020", 60.8), ("069", "FY2025", 57.02)],
                                   "division_code string, fiscal_year string, pct_of_total_budget double")
    enrol, spend = audit.normalise(enrol), audit.normalise(spend)
    ratios = audit.ratios(admin, taught, enrol)
    assert ratios.count() == 6
    shares = {r.division_code: r for r in audit.expenditure(spend, "FY2024").collect()}
    assert (shares["069"].local_pct, shares["069"].state_pct, shares["069"].federal_pct) == (46.9, 38.0, 6.1)
    assert shares["069"].variance_pct == -1.7
    _, enrol_growth = audit.trends(enrol, "adm")
    _, admin_growth = audit.trends(admin, "admin_positions")
    assert enrol_growth.first().total_growth_pct == 2.8 and admin_growth.first().total_growth_pct == 40.0
    ranks = {r.division_code: r.total_per_pupil_rank for r in audit.rankings(ratios, spend, "FY2024").collect()}
    assert ranks == {"043": 1, "069": 2}
    flags = audit.flags(ratios, admin_growth, enrol_growth, budget, "FY2024").collect()
    assert sorted(f.severity for f in flags) == ["CRITICAL", "INFO", "OK", "WARNING", "WARNING"]
    assert R.tally(audit.flags(ratios, admin_growth, enrol_growth, budget, "FY2024")).count() == 4


BOOK = ["TAX BOOK 2021", "43A- - 1- 63", "DOE JOHN", "12 MAIN ST", "WINCHESTER VA 22601", "LOT 12B IN STEPHENS", "CITY", "1.5 AC CL 2 ZN RA",
        "100,000 200,000 300,000", "1,800.00 ACCT- 77", "FH 900.00 SH", "900.00", "5,000", "DEFERRED",
        "44- - 2- 7", "ROE JANE", "PO BOX 9", "STRASBURG VA 22657", "5.0 AC CL 1", "ZN R2", "50,000 50,000 300.00 ACCT-", "78",
        *[f"NOTE {k} OF THE BOOK" for k in range(300)], "FH 150.00 SH 150.00",
        "45- - 3- 1", "LAST ONE", "1 2", "3 4.00 ACCT- 9", "46- - 3- 2", "VERY LAST"]


@pytest.mark.parametrize("chunk, piece", [(1000, 64), (7, 64), (1000, 4), (5, 4), (2, 64), (1, 64)])
@pytest.mark.parametrize("parse", [X.property_records, X.property_records_strict])
def test_records_in_pieces_match_whole_records(spark, monkeypatch, chunk, piece, parse):
    monkeypatch.setattr(X, "PIECE_LINES", piece)
    rows = spark.createDataFrame([(b, i, t) for b in ("one", "two") for i, t in enumerate(BOOK)], "path string, pos int, line string").repartition(3)
    place = F.floor(F.col("pos") / chunk)
    whole = parse(X.assemble_records(rows, ["path"], place, ["pos"]), ["path"])
    pieces = X.record_pieces(rows, ["path"], place, ["pos"])
    assert pieces.agg(F.max(F.size("lines"))).first()[0] <= max(piece, 1)
    got = parse(pieces, ["path"])
    assert got.columns == whole.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and got.count() >= 4


def test_medians_of_large_and_awkward_groups(spark, monkeypatch):
    monkeypatch.setattr(R, "BUCKETS", 8)
    rng = random.Random(5)
    groups = {"half": [rng.gauss(0, 1e6) for _ in range(3000)], "same": [7.5] * 400, "two": [1.0, 2.0], "one": [-3.0], "wide": [1e300, -1e300, 5e-324, 1.0, 2.0],
              None: [float(k % 13) for k in range(501)], "odd": [rng.choice([-0.0, 0.0, 1.0]) for _ in range(101)], "none": [None, float("nan")]}
    rows = spark.createDataFrame([(k, x) for k, xs in groups.items() for x in xs], "k string, x double").repartition(5)
    got = {r.k: r.median for r in R.medians(rows, "x", ["k"]).collect()}
    assert got == {k: statistics.median(xs) for k, xs in groups.items() if k != "none"}
    whole = [x for xs in groups.values() for x in xs if x is not None and not math.isnan(x)]
    assert R.medians(rows, "x").first().median == statistics.median(whole)
    assert R.medians(rows.filter("false"), "x", ["k"]).count() == 0
    stats = {r.k: tuple(r)[1:] for r in R.peer_stats(rows.filter("k IN ('two', 'same') OR k = 'none' AND x IS NULL"), "x", ["k"]).collect()}
    assert stats == {"two": (2, 1.5, 1.5, 0.71), "same": (400, 7.5, 7.5, 0.0), "none": (0, None, None, None)}


# --- several ranks of a table, lines of all kinds, personnel tables ------------------

def test_ranks_of_a_whole_table(spark):
    rng = random.Random(3)
    data = [(k, rng.choice([None, 1.5, 2.5, 2.5]), rng.choice(["a", "b", None])) for k in range(300)]
    rows = spark.createDataFrame(data, "key int, x double, y string").repartition(7)
    got = {r["key"]: (r["x_rank"], r["y_rank"]) for r in W.ordinal_ranks(rows, {"x": "desc", "y": "asc"}, "key").collect()}
    by_x = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    by_y = sorted(data, key=lambda r: (r[2] is None, r[2] or "", r[0]))
    assert got == {k: ([r[0] for r in by_x].index(k) + 1, [r[0] for r in by_y].index(k) + 1) for k in range(300)}
    assert W.ordinal_ranks(rows.limit(0), {"x": "desc"}, "key").count() == 0


def test_all_kinds_of_lines(spark):
    lines = ["Sheriff 1.5 2 3 4 5 6", " Parks/Recreation $1,000 $2 $3 ", "Nothing $0 $0 $0", "Public Safety $1 $2 $3 $4,000 5.5% x", "none", None]
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    assert rows_of(X.all_line_measures(rows, ["i"]), "i") == [
        (0, "personnel", "Sheriff", [1.5, 2.0, 3.0, 4.0, 5.0, 6.0]), (1, "expenditure", "Parks/Recreation", [1000.0, 2.0, 3.0, 1005.0]),
        (3, "summary", "Public Safety", [1.0, 2.0, 3.0, 4000.0, 5.5])]


def test_personnel_summary(spark):
    table = "PERSONNEL NEEDS\nFull-Time Part-Time\nsheriff .5 2 1.25 3 7 4\nIT/MIS 1 2 3 4 5\nTotal Positions All  Funds 9.5 1 2 3 4 5\nCounty of Frederick\nFinance 1 1 1 1 1 1"
    pages = [("a", 9, table.replace("7 4", "8 8")), ("a", 7, table), ("a", 1, "PERSONNEL NEEDS Full-Time"), ("b", 1, "personnel needs Full-Time Part-Time"),
             ("c", 1, None), ("d", 1, "Full-Time Part-Time PERSONNEL NEEDS")]
    rows = spark.createDataFrame(pages, "doc string, page int, text string").repartition(3)
    assert rows_of(X.personnel_summary(rows, ["doc"], "page", "text"), "kind") == [
        ("a", 7, "department", "sheriff", 0.5, 2.0, 1.25, 3.0, 7.0, 4.0), ("a", 7, "total", "all_funds_total", 9.5, 1.0, 2.0, 3.0, 4.0, 5.0)]


@pytest.mark.parametrize("batch", ["1", "3", "10000"])
@pytest.mark.parametrize("size, piece", [(1000, 64), (7, 4), (2, 64), (1, 64)])
def test_placed_lines_are_cut_like_sorted_ones(spark, monkeypatch, batch, size, piece):
    """Lines that lie in order in their task, several chunks in one, give the same pieces however the batches fall."""
    monkeypatch.setattr(X, "PIECE_LINES", piece)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = spark.createDataFrame([(b, i, t) for b in ("one", "two") for i, t in enumerate(BOOK)], "path string, pos int, line string").coalesce(1)
        place = F.floor(F.col("pos") / size)
        placed, moved = (X.record_pieces(r, ["path"], place, ["pos"], placed=p) for r, p in ((rows, True), (rows.repartition(5), False)))
        assert sorted(map(str, placed.collect())) == sorted(map(str, moved.collect())) and placed.count() >= 10
        whole = X.assemble_records(rows, ["path"], place, ["pos"])
        got = placed.groupBy("path", "record_id").agg(F.flatten(F.array_sort(F.collect_list(F.struct("at", "lines")))["lines"]).alias("lines"))
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.select("path", "record_id", "lines").collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_patterns_of_records_match_as_plain_ones(spark):
    """The patterns that give nothing back find what the plain ones find, and a long run takes no quadratic time."""
    plain = {fixed.RECORD_PATTERNS["acreage"]: r"(?i)([\d.]+)\s*(?:ACRES?|AC\b)", fixed.RECORD_PATTERNS["deferred_value"]: r"([\d,]+)\s*DEFERRED",
             fixed.VALUE_BLOCK: r"([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+\.?\d*)\s+ACCT-", fixed.VALUE_BLOCK_LAND_ONLY: r"([\d,]+)\s+([\d,]+)\s+([\d,]+\.?\d*)\s+ACCT-",
             fixed.VALUE_BLOCK_ANY: r"([\d,]+)\s+([\d,]+)\s+([\d,]+)\s+([\d,]+\.\d{2})",
             fixed.VALUE_BLOCK_LAND_ONLY_STRICT: r"(\d{1,3}(?:,\d{3})*)\s+(\d{1,3}(?:,\d{3})*)\s+(\d+\.?\d*)\s+ACCT",
             fixed.DESCRIPTION_PATTERNS[3]: r"(?i)([\w\s]+(?:SUBDIVISION|ESTATES?|VILLAGE|ACRES?|TRACT))"}
    rng = random.Random(11)
    words = ["1", "1234", "1,234", ",", "4.5", "6.00", "7.", ".8", "1.005", "9.10.11", " ", "\t", " ACCT-", " ACCT", "DEFERRED", "ACRES", "ac", "ACX", "Village", "/", "ab"]
    data = [("".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 20))),) for _ in range(5000)]
    rows = spark.createDataFrame([*data, ("1 2 3 4.001 2 3 4.00 ACCT- 5",), ("x1234 5 6.0 ACCT",)], "t string")
    for pattern, old in plain.items():
        one, two = (F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (pattern, old))
        assert rows.filter(one != two).count() == 0 and rows.filter(F.size(two) > 0).count() > 0
        assert rows.filter(F.regexp_instr("t", F.lit(pattern)) != F.regexp_instr("t", F.lit(old))).count() == 0
    long = spark.createDataFrame([("word " * 40_000 + "/ OAK TRACT",)], "t string")
    assert long.select(F.regexp_extract("t", fixed.DESCRIPTION_PATTERNS[3], 1)).first()[0] == " OAK TRACT"

"""Look-alike semantics that differ between the source dialects."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from wayfare.functions import recode, scalar
from wayfare.operators import aggregates, joins
from wayfare.plans import activity, highway, matrix, moves, network, popsyn, survey, transit
from wayfare.sources import scan, sink


def values(spark, col, ddl, expr):
    df = spark.createDataFrame([(v,) for v in col], ddl)
    return [r[0] for r in df.select(expr).collect()]


def test_income_bands_left_and_right_closed(spark):
    col = [-5.0, 0.0, 14999.0, 15000.0, 50000.0, 75000.0, 80000.0, None]
    left = values(spark, col, "x double", scalar.fn_find_interval("x", [15000, 50000, 75000]) + 1)
    right = values(spark, col, "x double", scalar.fn_cut_right("x", [0, 15000, 50000, 75000, float("inf")]))
    assert left == [1, 1, 1, 2, 3, 4, 4, None]
    assert right == [None, None, 0.0, 0.0, 15000.0, 50000.0, 75000.0, None]


def test_find_interval_with_even_tail_equals_listed_cuts(spark):
    cuts = [0.0] + [3 + i / 2 for i in range(50)]
    col = [-1.0, 0.0, 2.99, 3.0, 3.25, 3.5, 12.49, 27.0, 27.5, 99.0]
    got = values(spark, col, "x double", scalar.fn_find_interval("x", cuts))
    assert got == [sum(c <= x for c in cuts) for x in col]


def test_distance_band_conventions(spark):
    col = [-3, 0, 1, 88, 89, 500]
    assert values(spark, col, "x int", activity._band("x", 89)) == [0, 1, 2, 89, 90, 90]
    zero_is_null = scalar.fn_cut_right("x", list(range(0, 90)))
    assert values(spark, col, "x int", zero_is_null) == [None, None, 0, 87, 88, None]


def test_tour_purpose_for_time_of_day_leaves_8_and_9_null(spark):
    expr = recode.project_case_map("x", activity.TOUR_TOD_PURPOSE)
    assert values(spark, [0, 1, 2, 3, 7, 8, 9], "x int", expr) == [0, 1, 2, 3, 3, None, None]


@pytest.mark.parametrize(("capped", "want"), [("band", [1, 2, 4, 4]), ("cap", [0, 1, 3, 3])])
def test_capped_tour_counts(spark, capped, want):
    days = spark.createDataFrame([(i, 1, n, 0) for i, n in enumerate([0, 1, 3, 7])], "hhno int, pno int, wktours int, wkstops int")
    people = spark.createDataFrame([(i, 1, 1, 1) for i in range(4)], "hhno int, pno int, pptyp int, psexpfac int")
    out = activity.act_day_pattern_pday(days, people, capped).orderBy("hhno").collect()
    assert [r["wktopt"] for r in out] == want
    assert [r["tourstop"] for r in out] == [0, 1, 9, 9]


def test_stops_without_tours_have_no_pattern_code(spark):
    days = spark.createDataFrame([(1, 1, 0, 2)], "hhno int, pno int, wktours int, wkstops int")
    people = spark.createDataFrame([(1, 1, 1, 1)], "hhno int, pno int, pptyp int, psexpfac int")
    row = activity.act_day_pattern_pday(days, people).first()
    assert row["tourstop"] is None and row["wktostp"] == 2


def test_vehicle_availability_drops_households_without_persons(spark):
    hh = spark.createDataFrame([(1, 2, 10.0, 1), (2, 7, 99999.0, 1)], "hhno int, hhvehs int, hhincome double, hhtaz int")
    per = spark.createDataFrame([(2, 30)], "hhno int, pagey int")
    zones = spark.createDataFrame([(1, 4)], "taz int, district int")
    out = activity.act_vehicle_availability(hh, per, zones).collect()
    assert [(r["hhno"], r["vehcat"], r["inccat"], r["drivers"], r["hhdistrict"]) for r in out] == [(2, 4, 4, 1, 4)]


def test_crosstab_keeps_empty_cells_and_drops_outside(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (9, 1, 5.0), (None, 2, 1.0)], "x int, y int, w double")
    out = {(r["x"], r["y"]): r["value"] for r in aggregates.agg_crosstab_complete(df, "x", (1, 2), "y", (1, 2), "w").collect()}
    assert out == {(1, 1): 2.0, (1, 2): 0.0, (2, 1): 0.0, (2, 2): 0.0}


def test_majority_tie_goes_to_smaller_area(spark):
    df = spark.createDataFrame([(1, 7, 50), (1, 3, 50), (2, 1, 40), (2, 2, 30), (2, 3, 30), (3, 1, 0)], "t int, p int, w int")
    out = {r["t"]: r["p"] for r in aggregates.agg_majority_assign(df, "t", "p", "w").collect()}
    assert out == {1: 3}


def test_rounding_modes(spark):
    col = [0.5, 1.5, 2.5, 3.5]
    assert values(spark, col, "x double", scalar.fn_round_half_even("x").cast("int")) == [0, 2, 2, 4]
    assert values(spark, col, "x double", scalar.fn_round_half_away("x").cast("int")) == [1, 2, 3, 4]


def test_exploded_survey_weight_is_at_least_one(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 0.5), (3, 1.5), (4, 2.5)], "id int, w double")
    out = survey.sur_explode_linked(df, "w").groupBy("id").count().orderBy("id").collect()
    assert [r["count"] for r in out] == [1, 1, 2, 2]


def test_expand_drops_weights_below_one(spark):
    df = spark.createDataFrame([(1, 0), (2, -3), (3, 2)], "id int, w int")
    assert [(r["id"], r["n"]) for r in joins.join_theta_expand(df, "w").orderBy("n").collect()] == [(3, 1), (3, 2)]


def test_time_decode_switches_on_the_whole_column(spark):
    clock = spark.createDataFrame([(730,), (1545,), (60,)], "t int")
    minutes = spark.createDataFrame([(730,), (1545,), (61,)], "t int")
    assert [r["h"] for r in scalar.fn_time_decode(clock, "t", "h").collect()] == [7.5, 15.75, 1.0]
    assert [round(r["h"], 4) for r in scalar.fn_time_decode(minutes, "t", "h").collect()] == [12.1667, 25.75, 1.0167]


def test_periods_half_open_and_windows_inclusive(spark):
    assert values(spark, [359, 360, 539, 540, 900, 1079, 1080], "t int", scalar.fn_tod_period("t")) == ["OP", "AM", "AM", "OP", "PM", "PM", "OP"]
    ends = [21599, 21600, 32400, 32401, 64800]
    assert values(spark, ends, "t int", scalar.fn_tod_inclusive("t")) == ["OP", "AM", "AM", "OP", "PM"]


def test_overwrites_and_ladders(spark):
    rules = [(F.col("x") > 0, 1), (F.col("x") > 5, 2)]
    assert values(spark, [-1, 3, 9], "x int", recode.project_overwrite_recodes(rules, 0)) == [0, 1, 2]
    assert values(spark, [-1, 3, 9], "x int", recode.project_ordered_ladder(rules, 0)) == [0, 1, 1]


def test_unknown_sign_is_an_error(spark):
    with pytest.raises(KeyError):
        recode.filter_dynamic(spark.range(1), "id", "~", 1)


def test_bad_row_fails_the_load(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("id,x\n1,2.5\nseven,3\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        scan.scan_delimited(spark, str(path), "id int, x double").collect()


def test_junk_rows_and_nulls_are_skipped(spark, tmp_path):
    path = tmp_path / "junk.csv"
    path.write_text("Table B08\nid,kind,x,foot\n1,Estimate,5,z\n2,Margin,6,z\n3,Estimate,,z\n4,Estimate,8,z\n")
    schema = spark.createDataFrame([], "id int, kind string, x int, foot string").schema
    out = scan.scan_skip_junk(spark, str(path), schema, "id", lambda d: d["kind"] == "Estimate", drop=["kind", "foot"])
    assert sorted(map(tuple, out.collect())) == [(1, 5), (4, 8)]


def test_sentinels_fill_every_type(spark):
    df = spark.createDataFrame([(1, None, "N.A."), (None, 2.5, None)], "a int, b double, c string")
    assert [tuple(r) for r in sink.sentinel_nulls(df).collect()] == [(1, -9.0, "-8"), (-9, 2.5, "-9")]


def test_pivot_point_cases(spark):
    cells = [(1, 0.0, 4.0, 0.0), (2, 0.0, 4.0, 3.0), (3, 2.0, 0.0, 5.0), (4, 2.0, 4.0, 1.0), (5, 2.0, 4.0, 9.0), (6, 2.0, 4.0, 0.0)]
    frames = [spark.createDataFrame([(c[0], 1, c[i]) for c in cells if c[i]], "o int, d int, trips double") for i in (1, 2, 3)]
    out = {r["o"]: r["trips"] for r in matrix.mat_pivot_point(*frames, 1.5).collect()}
    assert out == {1: 4.0, 2: 7.0, 3: 3.0, 4: 2.0, 5: 4.0 * 1.5 + 9 - 3, 6: 0.0}


def test_vehicle_trips_keep_the_fraction(spark):
    cols = "otaz int, dtaz int, tmode int, trexpfac int, half int, arrtm int, deptm int"
    trips = spark.createDataFrame([(1, 2, 4, 1, 1, 400, 1000), (1, 2, 5, 1, 2, 400, 1000), (1, 2, 6, 1, 1, 400, 400)], cols)
    out = {r["core"]: r["trips"] for r in matrix.mat_pce_trips(trips).collect()}
    assert out == {"AM_Pass": 0.5, "PM_Pass": pytest.approx(1 / 3.5)}


def test_common_value_and_odme(spark):
    zones = spark.createDataFrame([(1, 9), (2, 9), (3, 8)], "taz int, district int")
    od = spark.createDataFrame([(1, 2, 10.0), (1, 3, 10.0)], "o int, d int, trips double")
    assert {r["d"]: r["same"] for r in matrix.mat_common_value(od, zones, "taz", "district").collect()} == {2: 1, 3: 0}
    bounded = od.withColumns({"low": F.lit(1.0), "high": F.lit(60.0)})
    paths = spark.createDataFrame([(1, 2, 100), (1, 2, 101), (1, 3, 102)], "o int, d int, link int")
    links = spark.createDataFrame([(100, 40, 10), (101, 10, 0), (102, 0, 5)], "link int, count int, volume int")
    out = {r["d"]: r["trips"] for r in matrix.mat_odme_factor(bounded, paths, links, "low", "high").collect()}
    assert out == {2: 20.0, 3: 10.0}


def test_peak_period_sums_hours_16_to_18(spark):
    rows = [(1, "AB", h, 10.0 * h, 10.0 * h, 0.1, 30, 1.0, 1.0, 0.0, 100.0, 200.0) for h in range(1, 25)]
    names = "id int, flow string, hour int, vol double, pce double, vc double, speed_row int, vmt double, vht double, delay_hours double, am_cap double, pm_cap double"
    row = highway.hwy_peak_stats(spark.createDataFrame(rows, names)).first()
    assert row["pmpd_vol"] == 160 + 170 + 180 and row["ampd_vol"] == 70 + 80 + 90 and row["pmpk_vol"] == 180


def test_starts_are_valued_at_class_volume(spark):
    hourly = spark.createDataFrame([(20, 100.0, 10.0, 0.0, 50.0, 5.0, 0.0)], "speed_row int, vmt_car double, vmt_su double, vmt_mu double, vol_car double, vol_su double, vol_mu double")
    rates = spark.createDataFrame([("car", "co", 5, 2.0), ("car", "co", 20, 1.0), ("su", "co", 5, 4.0), ("su", "co", 20, 3.0)], "cls string, measure string, speed int, rate double")
    out = {(r["cls"], r["kind"]): r["value"] for r in highway.hwy_fuel_emissions(hourly, rates, {"co": 1.0}).collect()}
    g = highway.GRAMS_TO_TONS
    assert out[("car", "start")] == pytest.approx(50 * 2 * g) and out[("su", "start")] == pytest.approx(5 * 4 * g)
    assert out[("car", "running")] == pytest.approx(100 * g) and out[("su", "running")] == pytest.approx(30 * g)


def test_connector_speed_goes_by_zone_size(spark):
    cols = "id int, length double, dir int, fc int, ab_lanes int, ba_lanes int, access int, median int, ramp int, turnlane int, pspeed int, taz_area double"
    links = spark.createDataFrame([(1, 0.5, 0, 98, 1, 1, 1, 0, 0, 0, 25, 3.14159 * 100)], cols)
    row = highway.hwy_free_flow_speed(links).first()
    assert row["factype"] == "cc" and row["ffspeed"] == pytest.approx(20 + 20 * 2.397895, abs=1e-4)
    assert row["fftime"] == pytest.approx(60 * 10 / row["ffspeed"])


def test_bands_include_the_top_one(spark):
    df = spark.createDataFrame([(60000.0, 66000.0), (100.0, 50.0)], "c double, v double")
    bands = [("low", 0, 1000), ("top", 50000, float("inf"))]
    out = {r["band"]: round(r["pct_error"], 6) for r in aggregates.agg_band_performance(df, "c", "v", bands).collect()}
    assert out == {"low": -50.0, "top": 10.0}


def test_ramp_share_leaves_ramps_out_of_freeway(spark):
    links = spark.createDataFrame([(2, 0, 65, 80.0), (2, 1, 35, 20.0), (4, 1, 55, 10.0)], "road_type int, ramp int, speed_limit int, vmt double")
    out = {r["road_type"]: r["fraction"] for r in moves.mov_ramp_fraction(links).collect()}
    assert out == {2: 0.2, 4: 0.0}


def test_directional_rows_swap_ends(spark):
    links = spark.createDataFrame([(1, 10, 20, 2, 0, 5.0, 6.0), (2, 20, 30, 1, 1, 7.0, 8.0)], "id int, from_id int, to_id int, ab_lanes int, ba_lanes int, ab_vol double, ba_vol double")
    out = sorted(tuple(r) for r in network.net_directional(links, ["vol"]).select("id", "flow", "from_id", "to_id", "lanes", "vol").collect())
    assert out == [(1, "AB", 10, 20, 2, 5.0), (2, "AB", 20, 30, 1, 7.0), (2, "BA", 30, 20, 1, 8.0)]


def test_projects_last_edit_wins_and_errors_are_reported(spark):
    links = spark.createDataFrame([(1, 30, 1), (2, 40, 1), (3, 50, 0), (4, 60, 0)], "id int, speed int, base int")
    edits = [
        (1, 1, "Modify", "speed", "35"), (2, 1, "Modify", "speed", "45"), (3, 2, "Remove", None, None), (4, 3, "Add", None, None),
        (5, 9, "Modify", "speed", "5"), (6, 1, "Modify", "colour", "red"), (7, 1, "Modify", "speed", "fast"),
    ]
    frame = spark.createDataFrame(edits, "seq int, id int, action string, field_name string, field_value string")
    net, errors = network.net_apply_projects(links, frame, F.col("base") > 0)
    assert sorted((r["id"], r["speed"]) for r in net.collect()) == [(1, 45), (3, 50)]
    assert sorted((r["seq"], r["error"]) for r in errors.collect()) == [(5, "does not exist"), (6, "field does not exist"), (7, "value cannot be read")]


def test_gtfs_exceptions_and_afternoon_window(spark, tmp_path):
    files = {
        "routes": "route_id,route_short_name\n28,Main\n",
        "trips": "route_id,service_id,trip_id,direction_id,shape_id\n28,wk,a,0,s1\n28,wk,b,0,s1\n28,sat,c,1,s2\n28,hol,d,1,s3\n28,off,e,0,s9\n",
        "stops": "stop_id,stop_name,stop_lat,stop_lon\n1,Main,35.0,-85.3\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\na,06:59:00,07:00:00,1,1\na,08:00:00,08:00:00,1,2\nb,07:30:00,07:30:00,1,1\nc,07:00:00,07:00:00,1,1\nd,16:00:00,16:00:00,1,1\ne,07:00:00,07:00:00,1,1\n",
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\nwk,1,1,1,1,1,0,0,20190801,20191231\nsat,0,0,0,0,0,1,0,20190801,20191231\noff,1,1,1,1,1,0,0,20190801,20191231\nold,1,1,1,1,1,1,1,20180101,20181231\n",
        "calendar_dates": "service_id,date,exception_type\nhol,20191016,1\noff,20191016,2\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.txt").write_text(text)
    feed = scan.scan_gtfs(spark, str(tmp_path))
    out = sorted((r["tod"], r["shape_id"], r["n_trips"]) for r in transit.trn_gtfs_service_trips(feed, "20191016").collect())
    assert out == [("AM", "s1", 2), ("PM", "s3", 1)]


def test_weekday_filter(spark):
    days = [(datetime.datetime(2019, 10, d),) for d in (14, 15, 16, 17, 18)] + [(datetime.datetime(2019, 9, 17),)]
    df = spark.createDataFrame(days, "ts timestamp_ntz")
    assert sorted(r["ts"].day for r in recode.filter_weekday_month(df, "ts", 10).collect()) == [15, 16, 17]


def test_geo_ids(spark):
    states = spark.createDataFrame([("Ohio", "39")], "state_name string, state_code string")
    counties = spark.createDataFrame([("39", "Lake County", "085")], "state_code string, county_name string, county_code string")
    df = spark.createDataFrame([("Census Tract 112.04, Lake County, Ohio",), ("Census Tract 4, Dade County, Ohio",)], "d string")
    assert sorted(str(r["geoid"]) for r in scalar.fn_geo_id_build(df, "d", states, counties).collect()) == ["39085011204", "None"]


def test_person_types(spark):
    cols = "hhid int, perid int, agep int, sex int, wkhp int, employed int, schg int"
    rows = [(1, 1, 3, 1, 0, 0, 0), (1, 2, 10, 1, 0, 0, 3), (1, 3, 40, 1, 40, 1, 0), (1, 4, 17, 1, 10, 1, 0), (1, 5, 20, 1, 0, 0, 5), (1, 6, 30, 1, 0, 0, 6), (1, 7, 30, 1, 10, 1, 0), (1, 8, 70, 1, 0, 0, 0), (1, 9, 50, 1, 0, 0, 0)]
    out = popsyn.pop_format_persons(spark.createDataFrame(rows, cols)).orderBy("pno").collect()
    assert [r["pptyp"] for r in out] == [8, 7, 1, 6, 6, 5, 2, 3, 4]
    assert [r["pno"] for r in out] == list(range(1, 10))

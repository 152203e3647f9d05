"""Whole splits of small hand-made features."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from shapes import as_pairs

from wayloom import FeatureIO, SplitConfig, Stage, split_features, split_network
from wayloom.functions.geodesy import distance
from wayloom.operators import cutting, network, reports
from wayloom.plans.splitter import run_report
from wayloom.sources import catalog, manifests
from wayloom.sources.feature_io import geometry_encoding, has_coordinates, read_features, write_features

ROAD = [(-122.18, 47.61), (-122.179, 47.6105), (-122.178, 47.61), (-122.177, 47.6102)]


@pytest.fixture(scope="module")
def table(spark):
    """Features with the published types of just the columns that the rows use."""
    types = {name: kind for name, kind in catalog.SPLIT_TABLE_COLUMNS.items() if name != "metrics"}
    types["geometry"] = "array<struct<x:double,y:double>>"
    # Before the split, references have no ranges.
    types["prohibited_transitions"] = types["prohibited_transitions"].replace(",start_lr:double,end_lr:double", "")
    types["destinations"] = types["destinations"].replace("to_segment_start_lr:double,to_segment_end_lr:double,", "")

    def make(rows):
        used = [n for n in types if n in ("id", "type", "geometry", "connectors") or any(n in r for r in rows)]
        schema = T.StructType.fromDDL(", ".join(f"`{n}` {types[n]}" for n in used))
        return spark.createDataFrame([[r.get(n) for n in used] for r in rows], schema)

    return make


def segment(id_, geometry, connectors, **more):
    return {"id": id_, "type": "segment", "geometry": geometry, "connectors": connectors, **more}


def connector(id_, point):
    return {"id": id_, "type": "connector", "geometry": [point]}


def when(heading=None):
    return (heading, None, None, None, None, None)


@pytest.fixture(scope="module")
def town(table):
    """A road with attributes, crossed at its second vertex and followed by another."""
    flags = [(["is_bridge", "is_link"], [0.0, 0.55]), (["is_link"], [0.55, 1.0])]
    ahead = [([("c3", "next")], "forward", when("forward"), None)]
    across = [([("c1", "road")], "backward", when("forward"), None), ([("c1", "nowhere")], "forward", when(), None)]
    chain = [([("c1", "road"), ("c3", "next")], "forward", when("forward"), None)]
    sign = [([("Centre", "street")], ["exit"], "c1", "road", "c1", ("forward",), "backward")]
    return table(
        [
            segment(
                "road",
                ROAD,
                [("c0", 0.0), ("c1", 0.35), ("c3", 1.0)],
                names=("Main", {"en": "Main"}, [("alt", None, "Old Main", [0.8, 1.0], None)]),
                road_flags=flags,
                road_surface=[("paved", [0.8, None])],
                subclass_rules=[("link", None)],
                prohibited_transitions=ahead,
                **{"class": "motorway"},
            ),
            segment("next", [ROAD[3], (-122.176, 47.61)], [("c3", 0.0), ("c4", 1.0)]),
            segment("side", [(-122.179, 47.609), ROAD[1]], [("c5", 0.0), ("c1", 1.0)], prohibited_transitions=across + chain, destinations=sign),
            *[connector(f"c{i}", p) for i, p in enumerate(ROAD) if i != 2],
            connector("c4", (-122.176, 47.61)),
            connector("c5", (-122.179, 47.609)),
        ]
    )


@pytest.fixture(scope="module")
def split_town(town):
    return split_features(town).persist()


def pieces_of(result, id_):
    return result.filter(F.col("id") == id_).orderBy("start_lr").collect()


def test_cut_at_everything(split_town):
    result = split_town
    a, b, c, d = pieces_of(result, "road")
    assert [p.start_lr for p in (a, b, c, d)] == [0.0, pytest.approx(0.3523, abs=0.001), 0.55, 0.8] and d.end_lr == 1.0
    assert [[(k.connector_id, k["at"]) for k in p.connectors] for p in (a, b, c, d)] == [
        [("c0", 0.0), ("c1", 1.0)],
        [("c1", 0.0), ("road@0.55", 1.0)],
        [("road@0.55", 0.0), ("road@0.8", 1.0)],
        [("road@0.8", 0.0), ("c3", 1.0)],
    ]
    assert [p.road_flags[0]["values"] for p in (a, b, c, d)] == [["is_bridge", "is_link"]] * 2 + [["is_link"]] * 2
    assert all(p.road_flags[0]["between"] is None and len(p.road_flags) == 1 for p in (a, b, c, d))
    assert [p.road_surface for p in (a, b, c)] == [None] * 3 and d.road_surface[0] == ("paved", None)
    assert [p.names.rules for p in (a, b, c)] == [None] * 3 and d.names.rules[0].value == "Old Main"
    assert all(p["class"] == "motorway" and p.subclass_rules == [("link", None)] for p in (a, b, c, d))
    assert a.metrics == {"length": "D. 1m-100m"} and as_pairs(a.geometry) == ROAD[:2]
    assert as_pairs(b.geometry)[-1] == as_pairs(c.geometry)[0] and as_pairs(d.geometry)[-1] == ROAD[-1]
    added = result.filter("type = 'connector' and id like '%@%'").orderBy("id").collect()
    assert [r.id for r in added] == ["road@0.55", "road@0.8"] and added[0].metrics is None


def test_cut_at_references_only(town):
    config = SplitConfig(split_at_connectors=False, lr_columns_to_exclude=["prohibited_transitions", "destinations"])
    a, b, c = pieces_of(split_features(town, config=config), "road")
    assert [k.connector_id for k in a.connectors] == ["c0", "c1", "road@0.55"]
    assert a.connectors[1]["at"] == pytest.approx(0.35 / 0.55, abs=1e-9)
    # More than two connectors on a piece: its turns cannot be told apart.
    assert a.prohibited_transitions is None and c.prohibited_transitions is not None
    assert [p.end_lr for p in (a, b, c)] == [0.55, 0.8, 1.0]


def test_turns_and_destinations_point_at_pieces(split_town):
    result = split_town
    *others, last = pieces_of(result, "road")
    assert all(p.prohibited_transitions is None for p in others)
    (turn,) = last.prohibited_transitions
    assert [tuple(s) for s in turn.sequence] == [("c3", "next", 0.0, 1.0)] and turn["when"].heading == "forward"
    (side,) = pieces_of(result, "side")
    # Backward at c1 is the piece before it; "nowhere" is unknown; the chain passes no single piece.
    assert [[s.segment_id for s in t.sequence] for t in side.prohibited_transitions] == [["road"]]
    step = side.prohibited_transitions[0].sequence[0]
    assert (step.start_lr, step.end_lr) == (0.0, others[0].end_lr)
    (sign,) = side.destinations
    assert (sign.to_segment_start_lr, sign.to_segment_end_lr) == (0.0, others[0].end_lr)
    assert sign.labels[0].value == "Centre" and sign.symbols == ["exit"] and sign["when"].heading == "forward"


def test_turn_through_a_middle_piece(table):
    chain = [([("b", "mid"), ("c", "end")], "backward", when("forward"), None)]
    points = {"a": (0.0, 0.0), "b": (0.001, 0.0), "c": (0.002, 0.0), "d": (0.003, 0.0), "z": (0.002, 0.001)}
    rows = [
        segment("start", [points["a"], points["b"]], [("a", 0.0), ("b", 1.0)], prohibited_transitions=chain),
        segment("mid", [points["b"], points["c"], points["d"]], [("b", 0.0), ("c", 0.5), ("d", 1.0)]),
        segment("end", [points["z"], points["c"]], [("z", 0.0), ("c", 1.0)]),
        *[connector(k, p) for k, p in points.items()],
    ]
    (row,) = pieces_of(split_features(table(rows)), "start")
    assert [tuple(s) for s in row.prohibited_transitions[0].sequence] == [("b", "mid", 0.0, 0.5), ("c", "end", 0.0, 1.0)]


def test_first_of_several_fitting_pieces(table):
    loop = [(0.0, 0.0), (0.001, 0.0), (0.001, 0.001), (0.0, 0.0), (-0.001, 0.0), (-0.001, -0.001)]
    turn = [([("o", "loop")], "forward", when(), None)]
    sign = [(None, None, "o", "loop", "o", ("backward",), "forward")]
    rows = [
        segment("in", [(0.0, 0.0), (0.0, -0.001)], [("o", 0.0), ("s", 1.0)], prohibited_transitions=turn, destinations=sign),
        segment("loop", loop, [("o", 0.0), ("p", 0.2), ("q", 0.4), ("o", 0.6), ("r", 1.0)], road_surface=[("x", [0.3, None])]),
        *[connector(k, p) for k, p in {"o": loop[0], "p": loop[1], "q": loop[2], "r": loop[5], "s": (0.0, -0.001)}.items()],
    ]
    result = split_features(table(rows)).cache()
    (row,) = pieces_of(result, "in")
    starts = [p.start_lr for p in pieces_of(result, "loop") if p.connectors[0].connector_id == "o"]
    assert row.prohibited_transitions[0].sequence[0].start_lr == min(starts)
    assert sorted(d.to_segment_start_lr for d in row.destinations) == sorted(starts)


FAR = (10.0, 10.0)
FAILURES = {
    "point": (segment("f", ROAD[:1], [("c0", 0.0)]), cutting.NOT_A_LINE),
    "astray": (segment("f", ROAD, [("c0", 0.0), ("far", 0.5), ("c3", 1.0)]), cutting.NOT_ON_LINE),
    "lonely": (segment("f", ROAD, [("c0", 0.0)]), cutting.FEW_POINTS),
    "ring": (segment("f", [ROAD[0], ROAD[1], ROAD[2], ROAD[0]], [("c0", 0.0), ("c0", 1.0)]), cutting.CLOSED_PIECE),
    "triple": (segment("f", ROAD, [("c0", 0.0), ("c3", 1.0)], road_surface=[("x", [0.1, 0.2, 0.3])]), cutting.MALFORMED_RANGE),
    "no list": (segment("f", ROAD, None, road_surface=[("x", [0.5, None])]), cutting.NO_POSITION),
    "no place": (segment("f", ROAD, [("c0", 0.0), ("c3", None)]), cutting.NO_POSITION),
    "still": (segment("f", [ROAD[0], ROAD[0]], [("c0", 0.0), ("c0", 1.0)]), cutting.ZERO_LENGTH),
    "fine": (segment("f", ROAD, [("c0", 0.0), ("c1", 0.4), ("c3", 1.0)]), ""),
}


def test_failure_rules(table):
    rows = [{**row, "id": name} for name, (row, _) in FAILURES.items()]
    rows += [connector(f"c{i}", p) for i, p in enumerate(ROAD)] + [connector("far", FAR)]
    features = table(rows)
    split = cutting.split_segments(network.join_connectors(features), ["road_surface"]).cache()
    got = {r.id: r.error_message for r in split.select("id", "error_message").collect()}
    assert got == {name: reason for name, (_, reason) in FAILURES.items()}
    assert {r.id for r in reports.errors(split).collect()} == set(FAILURES) - {"fine"}
    profile = {(r.is_success, r.error): r["count"] for r in reports.error_profile(split).collect()}
    assert profile[(True, "")] == 2 and profile[(False, cutting.NO_POSITION)] == 2
    whole = {r.id for r in split_features(features).filter("type = 'segment'").select("id").collect()}
    assert whole == {"fine"}
    config = SplitConfig(split_at_connectors=False)
    bare = table([segment("bare", ROAD, [("gone", 0.5)], road_surface=[("x", [0.5, None])])])
    split = cutting.split_segments(network.join_connectors(bare), ["road_surface"], config)
    assert split.first().error_message == cutting.NO_CONNECTOR
    # Cutting at connectors as well, missing ends get added and the unknown connector stays inside.
    (a, b) = pieces_of(split_features(bare), "bare")
    assert [k.connector_id for k in a.connectors] == ["bare@0", "bare@0.5"] and b.connectors[1].connector_id == "bare@1"


def test_connectors_off_the_vertices_never_go_back(table):
    line = [(0.0, 0.0), (0.002, 0.0), (0.002, 0.002), (0.0, 0.002)]
    inside = {"p": (0.0005, 0.0), "q": (0.0015, 0.0), "r": (0.002, 0.001), "s": (0.001, 0.002)}
    ends = {"a": line[0], "z": line[3]}
    order = ["a", "p", "q", "r", "s", "z"]
    rows = [segment("ok", line, [(k, i / 5) for i, k in enumerate(order)])]
    rows.append(segment("back", line, [(k, i / 5) for i, k in enumerate(["a", "r", "p", "z"])]))
    rows += [connector(k, p) for k, p in {**inside, **ends}.items()]
    split = cutting.split_segments(network.join_connectors(table(rows)), []).cache()
    ok = split.filter("id = 'ok'").first()
    assert [p.end_id for p in ok.pieces] == order[1:]
    assert [p.start_lr for p in ok.pieces][1:3] == pytest.approx([1 / 12, 3 / 12], abs=2e-3)
    assert split.filter("id = 'back'").first().error_message == cutting.NOT_ON_LINE


def test_connector_ids_stay_aligned_and_attributes_attach(town, spark):
    extra = spark.createDataFrame([("next", [("slow", [0.5, 1.0])])], "id string, zones array<struct<kind:string,between:array<double>>>")
    wide = network.attach_attributes(town, extra).withColumn("connector_ids", F.transform("connectors", lambda c: c.connector_id))
    a, b = pieces_of(split_features(wide), "next")
    assert a.zones is None and b.zones == [("slow", None)]
    assert [a.connector_ids, b.connector_ids] == [["c3", "next@0.5"], ["next@0.5", "c4"]]


def test_excluded_columns_keep_their_ranges(town):
    result = split_features(town, config=SplitConfig(lr_columns_to_include=["road_surface"]))
    assert [p.end_lr for p in pieces_of(result, "road")][1:] == [0.8, 1.0]
    assert pieces_of(result, "road")[0].road_flags[0]["between"] == [0.0, 0.55]
    with pytest.raises(ValueError):
        split_features(town, config=SplitConfig(lr_columns_to_include=["id"]))


def test_lengths_and_ends_add_up(spark):
    from wayloom.plans import derived

    features = derived.features(spark, "/root/testdata/sf0.001", references=True)
    result = split_features(features).filter("type = 'segment'").cache()
    ends = F.element_at("geometry", 1), F.element_at("geometry", -1)
    checks = result.select(
        "id", "start_lr", "end_lr", F.size("connectors").alias("n"), F.col("connectors")[0]["at"].alias("first"),
        F.element_at("connectors", -1)["at"].alias("last"),
        F.exists(F.coalesce("rules", F.array()), lambda r: F.size(r["between"]) != 2).alias("odd"),
        distance(ends[0].x, ends[0].y, ends[1].x, ends[1].y).alias("apart"),
    )
    assert checks.filter("n < 2 or first != 0 or last != 1 or end_lr <= start_lr or odd").count() == 0
    chained = result.groupBy("id").agg(F.sum(F.col("end_lr") - F.col("start_lr")).alias("covered"), F.min("start_lr").alias("a"), F.max("end_lr").alias("b"))
    assert chained.filter(F.abs(F.col("covered") - (F.col("b") - F.col("a"))) > 1e-9).count() == 0


def test_same_result_on_any_number_of_partitions(spark):
    from wayloom.plans import derived

    def digest(n):
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            result = split_features(derived.features(spark, "/root/testdata/sf0.001"))
            row = F.to_json(F.struct(*result.columns))
            return result.agg(F.count(F.lit(1)), F.sum(F.crc32(row.cast("binary")))).first()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)

    assert digest(2) == digest(8)


# ---------------------------------------------------------------- stages and storage


def test_stage_paths():
    io = FeatureIO("input/path/", "output/path/")
    # Names of the stored stages.
    assert [io.default_path_for_step(s) for s in Stage] == [
        "input/path",
        "output/path_1_spatially_filtered",
        "output/path_2_joined",
        "output/path_3_raw_split",
        "output/path_4_segments_splits",
        "output/path_final",
    ]
    with pytest.raises(AssertionError):
        FeatureIO("a", "b", custom_read_hook=lambda spark, stage, path: None)


def test_staged_split_equals_one_plan_and_reuses_stages(town, split_town, spark, tmp_path):
    wkt = "POLYGON ((-122.2 47.6, -122.17 47.6, -122.17 47.62, -122.2 47.62, -122.2 47.6))"
    write_features(town, f"{tmp_path}/in")
    assert not has_coordinates(spark, f"{tmp_path}/in") and not has_coordinates(spark, f"{tmp_path}/none")
    assert geometry_encoding(read_features(spark, f"{tmp_path}/in")) == "coords"
    io = FeatureIO(f"{tmp_path}/in", f"{tmp_path}/out")
    seen = {}
    result = split_network(spark, io, wkt, on_stage=lambda s, n: seen.__setitem__(s, n))
    assert seen == {
        Stage.spatial_filter: 8, Stage.joined: 3, Stage.raw_split: 3, Stage.segment_splits_exploded: 6, Stage.final_output: 13,
    }
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    expected = rows(split_town)
    assert rows(result) == expected
    assert {s for s in Stage if s != Stage.read_input and io.manifest(spark, s)} == set(seen)
    report = {(r.stage, r.report, r.key): r.value for r in run_report(spark, io).collect()}
    assert {s: report[s.value, "rows", ""] for s in seen} == seen
    assert report["3_raw_split", "outcomes", ""] == 6 and report["3_raw_split", "splits", "4"] == 1
    assert (report["final", "types", "segment"], report["final", "types", "connector"]) == (6, 7)
    assert sum(n for (s, r, k), n in report.items() if r == "metrics" and k.startswith("length ")) == 6
    again = []
    assert rows(split_network(spark, io, wkt, on_stage=lambda s, n: again.append(s))) == expected
    assert again == [Stage.final_output]
    afresh = []
    config = SplitConfig(reuse_existing_intermediate_outputs=False)
    assert rows(split_network(spark, io, wkt, config, on_stage=lambda s, n: afresh.append(s))) == expected
    assert afresh == list(seen)
    # Another polygon or other settings are another question.
    other = []
    split_network(spark, io, wkt.replace("47.62", "47.63"), on_stage=lambda s, n: other.append(s))
    assert other == list(seen)
    other.clear()
    split_network(spark, io, wkt, SplitConfig(point_precision=6), on_stage=lambda s, n: other.append(s))
    assert other == list(seen)


def test_incomplete_versions_are_not_whole(spark, tmp_path):
    path = f"{tmp_path}/stage"
    store = lambda n, settings: manifests.add_version(
        spark, path, lambda folder: spark.range(n).repartition(4).write.parquet(folder), settings
    )
    assert manifests.current(spark, path) is None and not manifests.is_whole(spark, None)
    first = store(100, "a")
    assert first.rows == 100 and first.files == 4
    assert manifests.is_whole(spark, first, "a") and not manifests.is_whole(spark, first, "b")

    def dies(folder):
        spark.range(7).write.parquet(folder)
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        manifests.add_version(spark, path, dies)
    assert manifests.current(spark, path) == first
    second, third = store(10, "b"), store(20, "c")
    assert manifests.current(spark, path) == third
    # The version before is kept for its readers, older ones are not.
    assert spark.read.parquet(second.location).count() == 10
    assert not (tmp_path / "stage" / "_versions" / first.version).exists()
    parts = sorted((tmp_path / "stage" / "_versions" / third.version).glob("part*"))
    parts[0].unlink()
    assert not manifests.is_whole(spark, third, "c")
    (tmp_path / "stage" / "_manifests" / "9999999999-x.json").write_text('{"rows": ')
    assert manifests.current(spark, path) == third


def test_changed_input_gets_fresh_pieces_and_readers_keep_theirs(town, spark, tmp_path):
    write_features(town.filter("id <> 'next'"), f"{tmp_path}/in/a")
    write_features(town.filter("id = 'next'"), f"{tmp_path}/in/b")
    io = FeatureIO(f"{tmp_path}/in/*", f"{tmp_path}/out")
    ids = lambda df: {r.id for r in df.filter("type = 'segment'").select("id").distinct().collect()}
    held, cut_lines = split_network(spark, io), io.read(spark, Stage.raw_split)
    # One file of the input changes: its rows are seen, under the same path.
    write_features(town.filter("id = 'next'").withColumn("id", F.lit("later")), f"{tmp_path}/in/b")
    made = []
    after = split_network(spark, io, on_stage=lambda s, n: made.append(s))
    assert made == [Stage.joined, Stage.raw_split, Stage.segment_splits_exploded, Stage.final_output]
    assert "later" in ids(after) and "next" not in ids(after)
    # Read only now, after all stages were made again.
    assert held.count() == 13 and cut_lines.count() == 3
    assert "next" in ids(held) and "later" not in ids(held)


def test_input_that_changes_meanwhile_is_refused(town, spark, tmp_path, monkeypatch):
    write_features(town, f"{tmp_path}/in")
    io = FeatureIO(f"{tmp_path}/in", f"{tmp_path}/out")
    states = iter(["first", "second"])
    monkeypatch.setattr(io, "input_state", lambda spark: next(states))
    with pytest.raises(RuntimeError, match="changed while"):
        split_network(spark, io)
    assert io.manifest(spark, Stage.joined) is None


def test_reports_start_no_jobs_of_their_own(split_town, spark, tmp_path):
    """What a run reports is seen while its stages are written: as many jobs with reports as without."""

    split_town.write.parquet(f"{tmp_path}/stored")

    def jobs(name, look):
        io = FeatureIO("in", f"{tmp_path}/{name}")
        df, report = look(spark.read.parquet(f"{tmp_path}/stored"))
        spark.sparkContext.setJobGroup(name, name)
        io.write(df, Stage.final_output, observed=report)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name)), io.manifest(spark, Stage.final_output)

    def rows_only(df):
        seen = Observation("rows")
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), lambda: dict(seen.get)

    plain, bare = jobs("plain", rows_only)
    full, told = jobs("full", lambda df: reports.observed(df, "final"))
    assert full == plain and bare.rows == told.rows == 13
    assert told.report["types"] == {"segment": 6, "connector": 7} and bare.report == {"rows": 13}


def test_names_of_own_columns_are_refused(town, spark, tmp_path):
    write_features(town.withColumn("refers", F.lit(1)), f"{tmp_path}/in")
    with pytest.raises(ValueError, match="refers"):
        split_network(spark, FeatureIO(f"{tmp_path}/in", f"{tmp_path}/out"))


def test_repeated_attributes_fail(town, spark):
    more = spark.createDataFrame([("next", 1), ("next", 2)], "id string, lanes int")
    with pytest.raises(Exception, match="repeated id among the attributes: next"):
        network.attach_attributes(town, more).collect()


def test_boxes_skip_row_groups(town, spark, tmp_path):
    from wayloom.operators.filters import spatial_filter
    from wayloom.sources.feature_io import read_parquet

    near = town.filter("id = 'c4'")
    x, y = F.element_at("geometry", 1)["x"], F.element_at("geometry", 1)["y"]
    many = near.crossJoin(spark.range(400).withColumnRenamed("id", "n")).withColumn("id", F.col("n").cast("string"))
    for i in range(4):
        box = F.struct((x + i).alias("xmin"), (x + i).alias("xmax"), y.alias("ymin"), y.alias("ymax"))
        moved = many.drop("n").withColumn("bbox", box).coalesce(1)
        write_features(moved, f"{tmp_path}/boxed/part={i}")
    wkt = "POLYGON ((-122.1765 47.6, -122.17 47.6, -122.17 47.62, -122.1765 47.62, -122.1765 47.6))"
    kept = spatial_filter(read_parquet(spark, f"{tmp_path}/boxed"), wkt)
    assert len(kept.collect()) == 400
    assert _scan_rows(kept) == [400]


def _scan_rows(df):
    """Output rows of the file scans of a DataFrame that was collected."""
    found = []

    def walk(node):
        metrics = node.metrics()
        if "Scan" in node.nodeName() and metrics.contains("numOutputRows"):
            found.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    walk(plan.executedPlan() if "Adaptive" in plan.nodeName() else plan)
    return found


def test_own_hooks(town, spark, tmp_path):
    kept, calls = {}, []

    def read(session, stage, path):
        calls.append(("read", stage, path))
        return town if stage == Stage.read_input else session.read.parquet(kept[stage])

    def exists(session, stage, path):
        calls.append(("exists", stage, path))
        return False

    def write(df, stage, path):
        calls.append(("write", stage, path))
        kept[stage] = f"{tmp_path}/{stage.name}"
        df.write.mode("overwrite").parquet(kept[stage])

    io = FeatureIO("in", "out/", read, exists, write)
    result = split_network(spark, io)
    assert result.filter("type = 'segment'").count() == 6
    assert {p for kind, s, p in calls if s == Stage.read_input} == {"in"} and {p for _, s, p in calls if s != Stage.read_input} == {"out"}
    bad = FeatureIO("in", "out", lambda *_: spark.range(1), exists, write)
    with pytest.raises(ValueError, match="geometry"):
        bad.read(spark, Stage.joined)
    assert bad.read(spark, Stage.raw_split).columns == ["id"]


def test_filter_keeps_what_meets_the_polygon(town):
    near = "POLYGON ((-122.1765 47.6, -122.17 47.6, -122.17 47.62, -122.1765 47.62, -122.1765 47.6))"
    from wayloom.operators.filters import spatial_filter

    assert {r.id for r in spatial_filter(town, near).collect()} == {"next", "c4"}
    box = F.struct(*[F.lit(v).alias(k) for k, v in {"xmin": 0.0, "xmax": 1.0, "ymin": 0.0, "ymax": 1.0}.items()])
    assert spatial_filter(town.withColumn("bbox", box), near).count() == 0


def test_published_table(split_town, spark, tmp_path):
    from wayloom.sources.feature_io import with_wkb

    result = split_town
    for name, kind in catalog.SPLIT_TABLE_COLUMNS.items():
        if name not in result.columns:
            result = result.withColumn(name, F.lit(None).cast(kind))
    with_wkb(result).write.parquet(f"{tmp_path}/final")
    spark.sql("DROP TABLE IF EXISTS published")
    catalog.publish(spark, "published", f"{tmp_path}/final")
    table = spark.table("published")
    assert table.columns == list(catalog.SPLIT_TABLE_COLUMNS)
    assert table.filter("type = 'segment' and start_lr = 0").count() == 3
    step = table.filter("prohibited_transitions is not null").select(F.explode("prohibited_transitions.sequence").alias("s"))
    assert step.filter("s[0].start_lr is not null").count() > 0
    assert table.filter("destinations[0].to_segment_start_lr is not null").count() > 0
    assert table.filter("element_at(metrics, 'length') is not null").count() == 6


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    for name, rows in (("one", 1_000), ("two", 3_000)):
        table = spark.range(rows).select((F.col("id") % 500).cast("string").alias("id"), F.col("id").alias(name))
        none = spark.createDataFrame([(None, 1)], f"id string, {name} long")
        spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
        catalog.publish_bucketed(table.union(none), f"bucketed_{name}", f"{tmp_path}/{name}", buckets=4)
    met = spark.table("bucketed_one").hint("merge").join(spark.table("bucketed_two"), "id")
    grouped = met.groupBy("id").agg(F.count("*").alias("n"))
    rows = grouped.collect()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 500 and {r.n for r in rows} == {12}
    assert spark.table("bucketed_two").count() == 3_001
    # Written again, the table holds the new rows alone.
    catalog.publish_bucketed(table.limit(7), "bucketed_two", f"{tmp_path}/two")
    assert spark.table("bucketed_two").count() == 7
    assert [catalog.buckets_for(n) for n in (0, 1, 1 << 20, (1 << 20) + 1, 5 << 20)] == [1, 1, 1, 2, 8]


def test_reports(town, split_town):
    result = split_town
    metrics = {(r.key, r.value): (r.value_count, r.percentage) for r in reports.metric_profile(result).collect()}
    assert sum(n for (k, _), (n, _) in metrics.items() if k == "length") == 6
    assert sum(p for (k, _), (_, p) in metrics.items() if k == "length") == pytest.approx(100, abs=0.02)
    assert {r.type: r["count"] for r in reports.type_counts(result).collect()} == {"segment": 6, "connector": 7}
    histogram = reports.splits_histogram(result.filter("type = 'segment'")).collect()
    assert [tuple(r) for r in histogram] == [(1, 2), (4, 1)]
    audit = reports.length_audit(cutting.split_segments(network.join_connectors(town), [])).first()
    assert audit.total_length_before_split == audit.total_length_after_split > 300

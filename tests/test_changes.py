"""Only lines that changed are cut again, and the result is that of a whole run."""

import pytest
from pyspark.sql import functions as F

from wayloom import FeatureIO, SplitConfig, Stage, split_network
from wayloom.operators import changes
from wayloom.plans.splitter import run_report
from wayloom.sources.feature_io import write_features

LINES = 300


def roads(spark, moved=(), gone=(), more=0):
    """A chain of roads with a reference in each, a turn from each to the next; `moved` have another shape."""
    lines = spark.range(LINES + more).filter(~F.col("id").isin(list(gone)) if gone else F.lit(True))
    place = "named_struct('x', 10D + {0} * 0.001D, 'y', 50D + {1})"
    bend = F.when(F.col("id").isin(list(moved)), 0.0003).otherwise(0.0001) if moved else F.lit(0.0001)
    segments = lines.withColumn("bend", bend).selectExpr(
        "concat('s', id) as id", "'segment' as type",
        f"array({place.format('id', '0D')}, {place.format('(id + 0.5D)', 'bend')}, {place.format('(id + 1)', '0D')}) as geometry",
        "array(named_struct('connector_id', concat('c', id), 'at', 0D), named_struct('connector_id', concat('c', id + 1), 'at', 1D)) as connectors",
        "array(named_struct('value', 'paved', 'between', array(0D, 0.5D))) as surface",
        """array(named_struct('sequence', array(named_struct('connector_id', concat('c', id + 1), 'segment_id', concat('s', id + 1))),
           'final_heading', 'forward', 'when', cast(null as struct<heading:string>))) as prohibited_transitions""",
    )
    points = spark.range(LINES + more + 1).selectExpr(
        "concat('c', id) as id", "'connector' as type", f"array({place.format('id', '0D')}) as geometry"
    )
    return segments.unionByName(points, allowMissingColumns=True)


def text_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def lines_cut(spark, io):
    return {r.key: r.value for r in run_report(spark, io).filter("report = 'lines'").collect()}


def test_only_changed_lines_are_cut(spark, tmp_path):
    io = FeatureIO(f"{tmp_path}/in", f"{tmp_path}/out")
    write_features(roads(spark), f"{tmp_path}/in")
    split_network(spark, io)
    assert lines_cut(spark, io) == {"cut": LINES, "taken": 0}
    # Two lines change their shape, two their common connector, one goes and one is new.
    moved = F.when(F.col("id") == "c50", F.expr("array(named_struct('x', 10.0495D, 'y', 50.0001D))")).otherwise(F.col("geometry"))
    changed = roads(spark, moved=(7, 200), gone=(100,), more=1).withColumn("geometry", moved)
    write_features(changed, f"{tmp_path}/in")
    seen = {}
    after = split_network(spark, io, on_stage=lambda s, n: seen.__setitem__(s, n))
    assert lines_cut(spark, io) == {"cut": 5, "taken": LINES - 5}
    assert seen[Stage.raw_split] == LINES
    whole = FeatureIO(f"{tmp_path}/in", f"{tmp_path}/whole")
    expected = text_rows(split_network(spark, whole))
    assert lines_cut(spark, whole)["cut"] == LINES
    assert text_rows(after) == expected
    for stage in (Stage.raw_split, Stage.segment_splits_exploded):
        assert text_rows(io.read(spark, stage)) == text_rows(whole.read(spark, stage))
    # Files written anew with the same rows: nothing is cut. Other rules: everything is.
    write_features(changed.repartition(3), f"{tmp_path}/in")
    assert text_rows(split_network(spark, io)) == expected
    assert lines_cut(spark, io) == {"cut": 0, "taken": LINES}
    split_network(spark, io, config=SplitConfig(point_precision=5))
    assert lines_cut(spark, io) == {"cut": LINES, "taken": 0}


def test_keys_tell_contents_apart(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES (null, 'a', array(null, 1D), timestamp'2020-01-01 00:00:00.000001'),
        ('a', null, array(null, 1D), timestamp'2020-01-01 00:00:00.000001'), ('a', null, array(1D, null), timestamp'2020-01-01 00:00:00.000001'),
        ('a', null, array(1D), timestamp'2020-01-01 00:00:00.000001'), ('a', null, null, timestamp'2020-01-01 00:00:00.000001'),
        ('a', null, array(), timestamp'2020-01-01 00:00:00.000001'), ('a', null, array(), timestamp'2020-01-01 00:00:00.000002'),
        ('a', '', array(), timestamp'2020-01-01 00:00:00.000002') AS t(a, b, c, d)"""
    )
    keys = [bytes(r[changes.CONTENT]) for r in changes.with_content_key(rows).collect()]
    assert len(set(keys)) == len(keys) == 8 and {len(k) for k in keys} == {16}
    turned = changes.with_content_key(rows.select("d", "c", "b", "a")).collect()
    assert [bytes(r[changes.CONTENT]) for r in turned] == keys


@pytest.mark.parametrize("broadcast_keys", [changes.BROADCAST_KEYS, 0])
def test_repeated_and_empty(spark, monkeypatch, broadcast_keys):
    monkeypatch.setattr(changes, "BROADCAST_KEYS", broadcast_keys)
    key = F.col("k").cast("binary").alias(changes.CONTENT)
    now = spark.sql("SELECT explode(split('a a a b c', ' ')) AS k").select(key)
    before = spark.sql("SELECT explode(split('a a b d', ' ')) AS k").select(key)
    keys, seen = changes.changed_keys(now, before)
    found = changes.Changes(keys, keys.count())
    as_text = lambda df: sorted(bytes(r[0]).decode() for r in df.collect())
    assert as_text(keys) == ["a", "c", "d"] and seen.get == {"rows": 3, "cut": 4}
    assert as_text(found.changed(now)) == ["a", "a", "a", "c"] and as_text(found.same(before)) == ["b"]
    nothing, seen = changes.changed_keys(now.limit(0), before.limit(0))
    none = changes.Changes(nothing, nothing.count())
    assert seen.get == {"rows": 0, "cut": 0}
    assert none.changed(now).count() == 0 and none.same(now).count() == 5

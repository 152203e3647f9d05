"""The filter never drops what matches, and drops nearly all else before it is shuffled."""

import pytest
from pyspark.sql import functions as F

from wayloom.operators import references
from wayloom.operators.bloom import LEAST_BITS, MOST_BITS, bits_for, bloom_filter, may_be_in

PIECES = "id string, piece_no int, start_lr double, end_lr double, connectors array<struct<connector_id:string,at:double>>"
ITEMS = (
    "id string, piece_no int, kind string, item int, step int, segment_id string, connector_id string, "
    "next_connector_id string, final_heading string"
)


@pytest.mark.parametrize("bits", [1 << 10, LEAST_BITS])
def test_members_pass_and_most_others_do_not(spark, bits):
    keys = spark.range(1_000).selectExpr("cast(id * 7 as string) as a", "id % 5 as b")
    keys = keys.union(spark.sql("select cast(null as string), 1L")).union(keys.limit(10))
    asked = spark.range(20_000).selectExpr("cast(id as string) as a", "(id div 7) % 5 as b", "id % 7 = 0 and id < 7000 as member")
    passed = asked.filter(may_be_in(bloom_filter(keys, ["a", "b"], bits), [F.col("a"), F.col("b")], bits))
    found = {r["member"]: r["count"] for r in passed.groupBy("member").count().collect()}
    assert found[True] == 1_000
    if bits == LEAST_BITS:  # 65 bits a key
        assert found.get(False, 0) < 20


def test_no_key_and_null_keys(spark):
    none = bloom_filter(spark.range(0).selectExpr("id as a"), ["a"])
    assert spark.range(100).filter(may_be_in(none, [F.col("id")])).count() == 0
    full = bloom_filter(spark.range(100).selectExpr("id as a"), ["a"])
    asked = spark.sql("select explode(array(1L, null, 5L)) as id")
    assert sorted(r.id for r in asked.filter(may_be_in(full, [F.col("id")])).collect()) == [1, 5]


def test_sizes():
    assert bits_for(0) == LEAST_BITS and bits_for(10**9) == MOST_BITS
    assert bits_for(100_000) == 1 << 20 and bits_for(104_858) == 1 << 21


def test_pieces_that_nothing_refers_to_are_not_shuffled(spark):
    pieces = spark.range(20_000).selectExpr(
        "cast(id as string) as id", "0 as piece_no", "0D as start_lr", "1D as end_lr",
        "array(struct(concat('c', id) as connector_id, 0D as at), struct(concat('c', id + 1) as connector_id, 1D as at)) as connectors",
    )
    items = spark.createDataFrame(
        [("a", 0, references.TURNS, i, 0, str(i * 20), f"c{i * 20}", None, "forward") for i in range(1_000)], ITEMS
    )
    kept = references.referenced_ends(pieces, items)
    rows = kept.collect()
    assert {(r.segment_id, r.connector_id) for r in rows} >= {(str(i * 20), f"c{i * 20}") for i in range(1_000)}
    assert len(rows) < 0.03 * 40_000
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    matched = references.match_items(items, pieces)
    assert matched.count() == 1_000
    # The filter stands right where the ends are read: no join, so no exchange, comes before it.
    plan = matched._jdf.queryExecution().optimizedPlan().toString()
    between = plan[plan.index("getbit") : plan.index("Generate posexplode")]
    assert "Join" not in between

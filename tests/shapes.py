"""Small helpers to write features in tests."""

import re

SEGMENT_DDL = (
    "id string, type string, geometry array<struct<x:double,y:double>>, "
    "connectors array<struct<connector_id:string,at:double>>"
)


def coords(wkt):
    body = re.search(r"\(([^()]*)\)", wkt)[1]
    return [tuple(float(v) for v in pair.split()) for pair in body.split(",")]


def feature(id_, kind, geometry, connectors=None, *more):
    return (id_, kind, geometry, connectors, *more)


def as_pairs(geometry):
    return [(p["x"], p["y"]) for p in geometry]

"""Synthetic payloads (every value invented), following FIXTURES.md part B."""

import json

BASE_DDL = (
    "type string, "
    "features array<struct<type: string, "
    "geometry: struct<type: string, coordinates: array<array<array<double>>>>, "
    "properties: struct<`h3-index`: string, routeId: string, n: bigint>>>"
)

RAW_GEOMETRY_DDL = (
    "type string, "
    "features array<struct<type: string, geometry: struct<type: string, coordinates: string>, "
    "properties: struct<`h3-index`: string, routeId: string, n: bigint>>>"
)


def feature(h3, route, n, coords=None, kind="Polygon"):
    return {"type": "Feature",
            "geometry": {"type": kind, "coordinates": coords if coords is not None else [[[1.5, 2.0], [3.0, 4.25]]]},
            "properties": {"h3-index": h3, "routeId": route, "n": n}}


def collection(*features):
    return {"type": "FeatureCollection", "features": list(features)}


OK = collection(feature("88a", "R1", 1), feature("88b", "R2", 2))
OK_TEXT = json.dumps(OK)
PRETTY_TEXT = json.dumps(OK, indent=2)
TOP_ARRAY_TEXT = json.dumps([OK, collection(feature("88c", "R3", 3))])
MIXED_TEXT = json.dumps(collection(
    feature("88a", "R1", 1, [[[1.5, 2], [3, 4]]], "Polygon"),
    feature("88m", "R9", 9, [[[[5, 6], [7.5, 8]]], [[[9, 10]]]], "MultiPolygon")))
MALFORMED_TEXT = "{bad"
ERROR_TEXT = json.dumps({"message": "no"})
EMPTY_TEXT = json.dumps({"features": []})
NULL_FEATURES_TEXT = json.dumps({"features": None})
NULL_ELEMENT_TEXT = json.dumps({"features": [None]})
CASE_CLASH_TEXT = json.dumps({"features": [{"properties": {"a": 1, "A": 2}}]})
DASH_CLASH = {"h3-index": "x", "h3index": "y"}
DUP_KEYS = collection(feature("88a", "R1", 1), feature("88a", "R1", 5))
NULL_KEY = collection(feature(None, "R1", 1), feature("88b", "R2", 2))

BATCH_1 = [("88a", "R1", 1), ("88b", "R2", 2), ("88c", "R3", 3)]
BATCH_2 = [("88b", "R2", 20), ("88d", "R4", 4), ("88a", "R1", 1)]   # 88c absent, 88b changed, 88d new

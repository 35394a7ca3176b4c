"""The original notebook's flow end to end: fetch -> land -> parse ->
explode -> expand -> split -> create-or-merge, run twice."""

import json

from pyspark.sql import functions as F

import plait as pl
from payloads import BASE_DDL


def test_fetch_to_tables_twice(spark):
    def api(key, url):                      # nested: pickled by value for the tasks
        k = int(key)
        if k == 13:
            return 403, json.dumps({"message": "no"})
        n = 100 if url.endswith("v2") else 1
        feats = [{"type": "Feature",
                  "geometry": {"type": "Polygon", "coordinates": [[[1.5, 2.0], [3.0, float(i)]]]},
                  "properties": {"h3-index": f"88{k}-{i}", "routeId": f"R{k}", "n": n * i}}
                 for i in range(3)]
        return 200, json.dumps({"type": "FeatureCollection", "features": feats})

    base = pl.shared_dir(spark)
    specs = None
    for version in ("v1", "v2"):
        reqs = spark.range(10, 16).select(F.col("id").alias("request_key"),
                                           F.concat(F.lit("/zip/"), F.col("id").cast("string"),
                                                    F.lit("/" + version)).alias("url"))
        landing = pl.session.scratch_path(spark, "landing", version)
        pl.land(pl.fetch(reqs, api, partitions=3), landing)
        parsed = pl.parse_json(spark.read.parquet(landing), "body", BASE_DDL, alias="doc")
        valid, quarantine = pl.split_valid(parsed, status="status")
        assert [r.request_key for r in quarantine.collect()] == ["13"]
        feats = pl.explode_rows(valid.select("doc.features"), "features", guard_reparse=True)
        feats = pl.expand_struct(feats, "col").drop("type")
        parts = pl.split(feats, {"coordinates": ["geometry.*"], "properties": ["properties.*"]},
                         key={"h3index": "properties.h3-index"}, persist=True)
        if specs is None:
            specs = {n: pl.table_spec(n, pl.session.unique_name(n), "default", f"{base}/flow/{pl.session.unique_name(n)}",
                                      key="h3index", buckets=4) for n in parts}
        counts = pl.load_split(parts, specs)
        if version == "v2":
            assert counts["properties"]["updated"] == 15 and counts["properties"]["inserted"] == 0
    props = spark.table(specs["properties"].qualified)
    assert props.columns == ["h3index", "routeId", "n"]
    assert props.count() == 15 and props.agg(F.max("n")).first()[0] == 200
    coords = spark.table(specs["coordinates"].qualified)
    assert coords.columns == ["h3index", "type", "coordinates"]
    assert pl.recombine([coords, props], "h3index").count() == 15

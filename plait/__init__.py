"""plait: nested-JSON ingestion and table maintenance on Spark.

Replies of web APIs (or any nested JSON) become clean relational tables:
read or fetch payloads as a distributed job, parse them with a declared or
inferred schema while setting malformed records aside, explode arrays and
flatten structs of any depth, make names SQL-safe, split wide records into
narrow tables sharing a key, check that key, and load the result with
replace, upsert or type-2 history semantics, in batch or incrementally.
"""

from .functions import safe_name, step
from .operators import (conform, dedupe_latest, drift_report, expand_struct, explode_rows,
                        first_rows, flatten, geometry_parts, key_report, key_summary, path_values, profile,
                        profile_sketch, read_profile, recombine, rename, sanitize_names, schema_rows, split,
                        unite_profiles)
from .operators.history import scd2_history
from .session import local_session, shared_dir
from .sinks import (TableSpec, append, check_specs, cluster, cluster_table, load, load_split,
                    merge_frames, read, replace, scd2_load, table_spec, upsert, vacuum, zorder)
from .sources import (call_due, read_requests, request_stream, write_round, CannedUserApi, HttpFetcher, fetch, geometry_columns, infer_file_schema,
                      infer_schema, land, nest, parse_json, read_payloads, split_valid,
                      status_check, to_bodies)
from .streaming import BatchMetrics, ingest_incremental, observed

__all__ = [
    "safe_name", "step", "conform", "dedupe_latest", "drift_report", "expand_struct",
    "explode_rows", "first_rows", "flatten", "key_report", "key_summary", "profile",
    "recombine", "rename", "sanitize_names", "schema_rows", "split", "scd2_history",
    "local_session", "shared_dir", "TableSpec", "append", "check_specs", "cluster",
    "cluster_table", "load", "load_split", "merge_frames", "replace", "scd2_load", "table_spec",
    "upsert", "vacuum", "zorder", "CannedUserApi", "HttpFetcher", "fetch", "geometry_columns",
    "infer_file_schema", "infer_schema", "land", "nest", "parse_json", "read_payloads",
    "split_valid", "status_check", "to_bodies", "ingest_incremental", "geometry_parts", "path_values",
    "profile_sketch", "read_profile", "unite_profiles", "read", "call_due", "read_requests", "request_stream",
    "write_round", "BatchMetrics", "observed",
]

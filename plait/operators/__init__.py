from .conform import SchemaDriftError, conform, drift, drift_report, merge_types
from .generate import explode_rows
from .inspect import first_rows, profile, profile_sketch, read_profile, schema_rows, unite_profiles
from .keys import DuplicateKeyError, assert_unique, dedupe_latest, key_report, key_summary
from .reshape import (Split, expand_struct, field, flatten, recombine, rename, sanitize_names,
                      split)
from .variants import geometry_parts, path_values

__all__ = [
    "SchemaDriftError", "conform", "drift", "drift_report", "explode_rows",
    "first_rows", "profile", "schema_rows", "DuplicateKeyError", "assert_unique",
    "dedupe_latest", "key_report", "key_summary", "Split", "expand_struct", "field",
    "flatten", "recombine", "rename", "sanitize_names", "split", "merge_types", "profile_sketch",
    "read_profile", "unite_profiles", "geometry_parts", "path_values",
]

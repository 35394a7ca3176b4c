from .names import NameCollisionError, check_unique, quote, rename_type, safe_name
from .schema import all_paths, ddl_from_variant_schema, leaf_paths, widen
from .steps import last_observation, step

__all__ = [
    "NameCollisionError", "check_unique", "quote", "rename_type", "safe_name",
    "all_paths", "ddl_from_variant_schema", "leaf_paths", "widen",
    "last_observation", "step",
]

from .layout import cluster, cluster_table, compact, declared_clustering, file_ranges, pruning, zorder, zorder_key
from .tables import (ConcurrentWriteError, TableSpec, append, check_specs, drop, exists, load, load_split, merge_frames,
                     prepare_source, read, register, replace, scd2_load, table_spec, upsert, vacuum, write_path)

__all__ = [
    "ConcurrentWriteError", "declared_clustering", "file_ranges", "pruning", "read", "append", "cluster", "cluster_table", "compact", "zorder", "zorder_key", "TableSpec", "check_specs",
    "drop", "exists", "load", "load_split", "merge_frames", "prepare_source", "register",
    "replace", "scd2_load", "table_spec", "upsert", "vacuum", "write_path",
]

from .documents import (ORDER_DOCUMENT_DDL, nest, order_bodies, order_documents,
                        to_bodies)
from .files import land_once, read_table
from .fetch import CannedUserApi, HttpFetcher, fetch, land, status_check
from .requests import call_due, due_calls, ledger, read_requests, request_stream, write_round
from .payloads import (CORRUPT, geometry_columns, infer_file_schema, infer_schema, parse_json,
                       read_payloads, split_valid)

__all__ = [
    "ORDER_DOCUMENT_DDL", "land_once", "read_table", "nest", "order_bodies",
    "order_documents", "to_bodies",
    "CannedUserApi", "HttpFetcher", "fetch", "land", "status_check",
    "call_due", "due_calls", "ledger", "read_requests", "request_stream", "write_round",
    "CORRUPT", "geometry_columns", "infer_file_schema", "infer_schema", "parse_json",
    "read_payloads", "split_valid",
]

from .catalogue import QUERIES, flagship
from .oracle import ORACLE

__all__ = ["QUERIES", "ORACLE", "flagship"]

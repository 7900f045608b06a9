"""Named queries over the test tables, with the SQL that checks them."""

from .batch import BATCH
from .sql import SQL
from .streams import STREAMS

QUERIES = {**BATCH, **STREAMS}

__all__ = ["BATCH", "QUERIES", "SQL", "STREAMS"]

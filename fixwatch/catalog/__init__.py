"""Every operator bound to the driver's tables, next to the SQL that must agree with it."""

from fixwatch.catalog import epochs, notices, qc, reports, spans, stations, streams, texts
from fixwatch.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "epochs", "notices", "qc", "reports", "spans", "stations", "streams", "texts"]

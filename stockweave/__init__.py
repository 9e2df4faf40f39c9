"""Omnichannel stock and sales reconciliation, expressed as Spark jobs."""

__version__ = "0.1.0"

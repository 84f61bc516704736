"""Importing this module registers every query."""

from tidelog.plans import metric_queries, recovery_queries, row_queries, scan_queries, sink_queries

MODULES = (scan_queries, row_queries, metric_queries, sink_queries, recovery_queries)

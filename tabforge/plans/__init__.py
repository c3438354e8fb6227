"""Plan-level building blocks and the query catalog.

prefix      exact running sums / dense indexes without a one-task window
joins       size-checked broadcast joins, reliable checkpoints
monitoring  the request-log → monitoring-table refresh job
registry    catalog registration; catalog_*.py hold the queries and oracles
"""

"""The registered queries: view and datapoint tables mapped from the given tables, queries over them, and oracle SQL."""

from workload import instances, records, series, sql, statuses

MODULES = (instances, records, series, sql, statuses)

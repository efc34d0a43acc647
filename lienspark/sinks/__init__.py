"""Writers."""

from lienspark.sinks.curved import read_curved, write_curved
from lienspark.sinks.lake import publish_year, write_by_state, write_clustered, write_rates
from lienspark.sinks.warehouse import create_loan_table, partition_keys, replace_year

__all__ = [
    "create_loan_table",
    "partition_keys",
    "publish_year",
    "read_curved",
    "replace_year",
    "write_by_state",
    "write_clustered",
    "write_curved",
    "write_rates",
]

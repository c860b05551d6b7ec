"""Independent DuckDB formulations of the registered queries (correctness oracle).

The marts are written here as flat SQL (one SELECT with all joins, DISTINCT
over the final output) so the check also covers the Spark plans'
restructurings (pre-joined status side, DISTINCT pushed below the study x
patient join, aggregate + semi join for latest-per-group).
"""

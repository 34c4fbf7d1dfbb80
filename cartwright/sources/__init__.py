from cartwright.sources.tables import TableSource, read_tables
from cartwright.sources.shop import RetailSources, from_tpch, from_tables
from cartwright.sources.sinks import (
    Runs, as_view, read_table, save_as_table, write_bucketed, write_table)

__all__ = ["TableSource", "read_tables", "RetailSources", "from_tpch", "from_tables",
           "Runs", "as_view", "write_table", "write_bucketed", "save_as_table", "read_table"]

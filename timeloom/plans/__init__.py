"""Plans over the driver's tables: how each operator is run on the
TPC-H-like test data (``driver``), its DuckDB twin (``oracle``) and the
query catalogue (``catalog``)."""

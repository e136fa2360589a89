"""Plans: store marts (``marts``), test-table bindings (``bindings``), the
DuckDB oracle (``oracle``) and the batch runner (``etl``)."""

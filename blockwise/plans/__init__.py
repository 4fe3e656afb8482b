"""The four jobs, the driver query catalogue, its DuckDB oracle and the CLI."""

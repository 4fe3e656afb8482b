"""Inputs: raw files (``files``) and the driver's parquet tables (``tables``)."""

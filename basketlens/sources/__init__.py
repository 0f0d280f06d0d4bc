"""Readers and writers: raw CSV (I1), Parquet/CSV sinks (I14), test-table adapter."""

from basketlens.sources.files import read_raw, write_extract, write_table  # noqa: F401

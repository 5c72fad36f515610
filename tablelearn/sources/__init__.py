"""Readers: delimited text (as the textbook examples use) and parquet tables."""

from .csv import read_csv, read_csv_format, read_csv_strings
from .tables import TABLES, read_table

__all__ = ["read_csv", "read_csv_format", "read_csv_strings", "TABLES", "read_table"]

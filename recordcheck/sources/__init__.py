"""Inputs and outputs: driver tables, test fixture, delimited text, parquet."""

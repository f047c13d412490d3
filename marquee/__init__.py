"""Layered catalogue analytics on Spark DataFrames: raw text, clean tables, star schema."""

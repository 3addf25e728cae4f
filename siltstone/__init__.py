"""Batch lakehouse analytics over keyed incident records, on Spark DataFrames."""

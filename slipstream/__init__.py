"""Slipstream: archived motorsport timing feeds as Spark DataFrames."""

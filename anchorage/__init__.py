"""Anchored cohort and feature engine on Spark DataFrames."""

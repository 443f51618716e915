"""Warehouse models as functions from DataFrames to DataFrames: staging, core, quality, marts, reports."""

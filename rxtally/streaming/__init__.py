"""Incremental refresh of stored history.

The workload has no event stream: its only moving input is a fact table that
grows by whole months, which is handled here as a gated batch append.
"""

"""Whole pipelines: staging projections, marts, their declared checks and the check-gated build."""

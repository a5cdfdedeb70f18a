"""Whole-layer runs and the analytic queries over the star."""

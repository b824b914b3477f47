"""Operators on panels: time series (by entity), cross section (by date), preparation."""

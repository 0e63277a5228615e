"""Panel operators: cross-section (per date) and time series (per asset)."""

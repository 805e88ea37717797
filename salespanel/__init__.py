"""Sales-panel analytics on Spark: cleaning, monthly panels, forecasting, reports."""

"""Travel-demand and transport-planning analytics on Spark DataFrames."""

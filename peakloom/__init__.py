"""Single-cell chromatin-accessibility analytics on Spark DataFrames."""

"""Product-catalogue and listing-reconciliation jobs on Spark DataFrames."""

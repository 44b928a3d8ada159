"""Trade reconciliation and control analytics on Spark DataFrames."""

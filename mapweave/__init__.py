"""mapweave: requirement mapping, coverage and gap analytics on Spark DataFrames."""

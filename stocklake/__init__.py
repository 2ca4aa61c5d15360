"""Stock, company and news lakehouse jobs on Spark DataFrames."""

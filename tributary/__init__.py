"""Raw business records in, one validated and merged table out, on Spark DataFrames."""

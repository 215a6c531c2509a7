"""shelflog: inventory and price history on Spark DataFrames."""

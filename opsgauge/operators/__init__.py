"""DataFrame operators. Each takes DataFrames and returns a lazy DataFrame or a Column."""

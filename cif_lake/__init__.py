"""Query collections of macromolecular CIF files as Spark DataFrames."""

"""loomsift: curate web text with PySpark DataFrames."""

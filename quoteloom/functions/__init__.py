"""Column functions: everything here is a Column -> Column expression."""

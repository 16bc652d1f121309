"""Column expressions: cell cleaning, exact rates, labels, bands."""

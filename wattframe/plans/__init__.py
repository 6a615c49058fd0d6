"""Domain views over the given tables, composed forecasts, and the registered queries."""

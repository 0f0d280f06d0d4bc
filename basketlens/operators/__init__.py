"""Analytics operators: DataFrame(s) + keyword parameters -> DataFrame."""

"""Table operators: DataFrame to DataFrame, for use with ``transform``."""

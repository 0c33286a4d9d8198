"""Plan fragments over DataFrames."""

"""Column types, values and schemas."""

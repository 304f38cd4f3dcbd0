"""Column functions on VARIANT items: types, values, text and geometry."""

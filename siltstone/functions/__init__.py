"""Column -> Column building blocks. All are native expressions, so plans stay in codegen."""

"""Column expressions: text parsing, numeric coercion, price arithmetic."""

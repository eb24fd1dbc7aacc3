"""Column expressions: value coercion, instance ids and time literals."""

"""Column functions: text, numbers, timestamps."""

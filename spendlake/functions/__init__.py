"""Column functions: text, dates and change types."""

"""Column expressions: text, chat turns and text strategies."""

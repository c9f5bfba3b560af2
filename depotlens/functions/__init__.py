"""Column expressions and the rule constants."""

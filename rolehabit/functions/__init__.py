"""Column expressions: time, text, trust policies and payloads."""

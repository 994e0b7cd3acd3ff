"""Column expressions: keys, text, dates, metadata, stance and measures."""

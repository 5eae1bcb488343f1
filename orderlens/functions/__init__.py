"""Column expressions: geography, calendar, labels and bins."""

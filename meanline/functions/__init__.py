"""Column expressions: cleaning, calendar, recodes."""

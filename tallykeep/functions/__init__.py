"""Column expressions: dates, money, display strings, countries."""

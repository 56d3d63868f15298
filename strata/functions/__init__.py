"""Column expressions: functions that take and return ``Column`` and never touch a DataFrame."""

"""Column functions: money, text, credit rules and time formats."""

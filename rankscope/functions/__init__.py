"""Column helpers: they build expressions and never touch data."""

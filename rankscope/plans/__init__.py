"""Whole plans: chart-shaped tables, the registered queries, and the two studies end to end."""

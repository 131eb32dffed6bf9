"""Column expressions: clocks and dates, occupancy scores, casts."""

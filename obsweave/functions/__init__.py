"""Column functions: no jobs, no state, everything stays inside Catalyst."""

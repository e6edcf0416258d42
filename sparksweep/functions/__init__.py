"""Column-level helpers: search-space draws, config rendering, user functions (barrier runs, job options, sweeps by function)."""

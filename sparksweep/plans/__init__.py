"""Plans: the sweep, fixture views with their DuckDB twins, search-space read-back and the registry of named queries (q_*.py)."""

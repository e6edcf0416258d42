"""DataFrame operators: filters and joins over jobs and steps, status folds, requirement merges, catalogs, datasets, sinks and the skew-safe row index."""

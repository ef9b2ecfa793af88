"""Plans: the single-table load, batch runs and the registry of checked queries."""

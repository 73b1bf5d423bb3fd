"""Plans: join helpers, scratch locations, test bindings, query catalogue."""

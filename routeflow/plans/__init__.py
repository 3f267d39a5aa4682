"""Plans: layer layout, query catalog and oracle SQL."""

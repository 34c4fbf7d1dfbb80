"""Plans: the model graph, the query registry, oracle SQL and the build order."""

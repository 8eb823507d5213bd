"""Plans: indexes and searches put together from the operators."""

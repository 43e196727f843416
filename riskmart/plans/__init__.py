"""Plans: the ordered layer build, the batch investigation, the query catalog."""

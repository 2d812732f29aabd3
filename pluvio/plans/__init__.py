"""Stand-in inputs, pipelines (published tables) and the query catalogue."""

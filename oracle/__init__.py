"""Independent SQL for every registered query, for an in-process SQL engine."""

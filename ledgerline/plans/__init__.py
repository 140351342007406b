"""Plans: the table dependency graph and full / incremental runs."""

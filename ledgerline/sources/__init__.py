"""Sources and sinks: raw tables, seeds, test fixtures, versioned table store."""

"""Jobs: operators chained into whole runs."""

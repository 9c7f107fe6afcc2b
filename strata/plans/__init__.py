"""Plans: table declarations, the pipeline run, view refresh, event log, verification queries."""

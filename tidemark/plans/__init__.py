"""Plans: versions, projections and whole refresh runs on disk."""

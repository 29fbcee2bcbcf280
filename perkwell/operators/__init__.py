"""Reports, scores, batch jobs, upkeep jobs and data checks over loyalty tables."""

"""Models built from the operators: staging, rollups, marts, quality, runs."""

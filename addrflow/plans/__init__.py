"""Plans: the end-to-end job and the named queries registered for checking and benchmarking."""

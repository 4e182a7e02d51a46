"""The data jobs: each a pure function from input tables to output tables."""

"""Column-level building blocks: hashing, cleaning, clock, contracts."""

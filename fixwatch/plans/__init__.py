"""End-to-end runs: read, derive, write."""

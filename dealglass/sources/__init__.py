"""Reading, loading and writing the domain tables."""

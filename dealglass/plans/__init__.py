"""Plan building blocks: rollups, skew-safe joins, ordering."""

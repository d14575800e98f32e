"""Reading, checking, landing and writing tables."""

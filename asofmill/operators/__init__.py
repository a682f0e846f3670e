"""operators of asofmill."""

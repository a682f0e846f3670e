"""streaming of asofmill."""

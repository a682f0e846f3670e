"""sources of asofmill."""

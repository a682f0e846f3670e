"""functions of asofmill."""

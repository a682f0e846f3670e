"""plans of asofmill."""

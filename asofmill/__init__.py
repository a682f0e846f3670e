"""asofmill: point-in-time market analytics and training-data operators on Spark."""

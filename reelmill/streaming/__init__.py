"""The snapshot job as a stream over the landing folder."""

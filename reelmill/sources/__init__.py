"""Readers for landed files and the versioned table store."""

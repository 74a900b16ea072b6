"""Table publication."""

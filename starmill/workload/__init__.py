"""The star-schema plans applied to the TPC-H-like test tables."""

"""Scans and literal relations."""

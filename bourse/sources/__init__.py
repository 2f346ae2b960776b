"""Readers, the ISO calendar and test-table fixtures."""

"""Readers, writers and the synthetic load-test source."""

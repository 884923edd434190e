"""Readers: landed snapshots, record envelopes, the country list."""

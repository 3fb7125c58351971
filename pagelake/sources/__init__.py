"""Readers of tables, manifests and specifications."""

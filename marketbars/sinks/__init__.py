"""Catalog tables: creating, loading, replacing and versioning them."""

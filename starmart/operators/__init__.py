"""Reusable relational steps that stay distributed whatever the key distribution."""

"""Readers for tables, numbered pages and landed payloads."""

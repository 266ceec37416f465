"""Readers for ERP tables, catalog sheets and landed web documents; report sinks."""

"""Readers that turn landed JSON (instance pages, series payloads) into rows."""

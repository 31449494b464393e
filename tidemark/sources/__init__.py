"""Readers with declared schemas, the table catalog, and driver-table adapters."""

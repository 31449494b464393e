"""Event lakehouse on PySpark: validate, quarantine, clean, model, serve, watch."""

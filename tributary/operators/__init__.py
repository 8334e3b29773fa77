"""Relational, encoding, splitting, metric, loss and audit operators."""

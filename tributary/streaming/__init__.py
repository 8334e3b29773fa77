"""Fitted tables applied to streams."""

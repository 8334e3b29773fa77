"""Whole workloads built from the operators."""

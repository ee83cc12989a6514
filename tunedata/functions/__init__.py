"""Scalar column helpers (JVM-side expressions only)."""

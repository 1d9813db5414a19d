"""Scalar expressions; every function returns a ``Column``."""

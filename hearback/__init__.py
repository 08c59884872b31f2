"""Spark jobs that turn user-feedback exports into one pseudonymised evidence base."""

__version__ = "0.1.0"

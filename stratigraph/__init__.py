"""Assemblage dating and graph analytics as plain Spark DataFrame functions."""

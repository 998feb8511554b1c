"""Preparation and evaluation of (diff, message) text pairs as Spark DataFrame operators."""

"""Runnable steps: they compose operators, write outputs and return statistics."""

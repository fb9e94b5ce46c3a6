"""Operators that a training-data pipeline needs beside the change-data engine.

Nothing else in the library imports this subpackage.
"""

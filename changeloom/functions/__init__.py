"""Scalar functions as Spark column expressions, and the wire codec."""

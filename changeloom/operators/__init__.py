"""Operators over change tables, source tables, topic logs and progress logs: DataFrame in, DataFrame out."""

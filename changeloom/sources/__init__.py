"""Readers and writers of topic logs and tables, and the derived fixture views."""

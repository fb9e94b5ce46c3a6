"""The continuous pipeline: source, transformation, idempotent sink, metrics."""

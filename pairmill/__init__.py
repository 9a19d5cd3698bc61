"""Prepare, lay out, generate from, gate and audit instruction/response data on Spark."""

"""Operators of a training-corpus pipeline. Nothing outside this folder imports it."""

"""Operators for preparing training data, their pipeline stages and their queries."""

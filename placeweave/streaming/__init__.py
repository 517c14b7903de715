"""Streams of transactions into cumulative pair statistics."""

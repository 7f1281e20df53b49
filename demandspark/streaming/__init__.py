"""Streaming: intentionally empty.

The source pipeline has no stream, watermark, window or state code; its only
incremental read (training rows in fixed-size chunks) is a batch operator and
lives in ``operators.splits`` as chunk ids. No streaming operator is built.
"""

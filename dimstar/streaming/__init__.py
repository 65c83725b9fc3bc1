"""Streaming: intentionally empty.

The source system loads by full rebuild only (no watermark, window, late
data or state store), so there is no streaming operator to rebuild. A
continuous feed is served by re-running the batch load into a new warehouse
version (``dimstar.plans.load.write_warehouse``), which readers pick up
through the version pointer.
"""

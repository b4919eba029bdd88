"""Streaming jobs.

The reporting system is batch; its one incremental job (re-tagging street
segments changed since the last run) is expressed here as a Structured
Streaming query with an ``availableNow`` trigger — see ``segment_updates``.
"""

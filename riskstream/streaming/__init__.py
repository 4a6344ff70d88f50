"""Streaming and backfill jobs, and where they write."""

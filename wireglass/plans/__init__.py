"""Reusable plan shapes: measured buckets, ordered runs, interval and as-of joins, checks."""

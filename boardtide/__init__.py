"""Posting analytics on Spark: normalise, snapshot, diff, classify, resolve, select."""

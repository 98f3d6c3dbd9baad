"""Incremental jobs: file landing, merge into the session fact, freshness and alerts."""

"""Inputs and outputs: raw-feed adapter, seeds, partitioned writes, merge, compaction, ingest."""

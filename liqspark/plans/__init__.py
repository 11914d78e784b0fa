"""Wiring: the model lineage, the daily pipeline, the check suite, registered queries, their SQL oracle, jobs."""

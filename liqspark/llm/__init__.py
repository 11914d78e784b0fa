"""Training-data pipeline operators (toxicity, fingerprints, sharding, token
files, packing, decontamination, near-duplicates, URL, license and secret scans).

Nothing else in the library imports this subpackage.
"""

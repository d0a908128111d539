"""Training-data operators: scans, classifiers, near-duplicates, search, mixing and packing.

Nothing outside this folder imports it; ``QUERIES`` and ``ORACLES`` in :mod:`.registry` are what the driver contract adds.
"""

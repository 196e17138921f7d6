"""Operators of a training-data pipeline: mixing, sharding, quality rules,
token files, line dedup, licence scans, language ID, decontamination,
toxicity and near-duplicate detection.

Nothing outside this package imports it.  Tables are read from and written
to shared storage only (``spark.checkpoint.dir``); no ``localCheckpoint``.
"""

"""Tabular price analytics expressed as Spark DataFrame programs.

``functions``  pure Column -> Column expressions
``operators``  DataFrame -> DataFrame steps (contracts, profiles, splits, drift, metrics)
``sources``    readers, writers, snapshots, the metric log and the model registry
``learning``   feature preparation, estimators, time-ordered search, importance, promotion
``streaming``  file-stream jobs
``plans``      the end-to-end jobs
``queries``    the same operators applied to the benchmark tables, each with its SQL twin
"""

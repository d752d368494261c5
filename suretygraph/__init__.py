"""Guarantee-risk analytics as Spark DataFrame jobs.

``sources``    file scans and the mapping from the benchmark tables
``functions``  column expressions (risk scores, vendor rules)
``operators``  DataFrame -> DataFrame steps, all lazy except where a docstring says otherwise
``sinks``      re-runnable writers
``plans``      the composed jobs and the catalogue of registered queries
"""

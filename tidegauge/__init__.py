"""Market, FX and macro risk analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame. Nothing here
triggers a job except the writers in :mod:`tidegauge.sinks` and the entry points
in :mod:`tidegauge.plans.jobs`.
"""

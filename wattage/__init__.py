"""wattage: hourly metered readings on Spark.

Operators (``wattage.operators``) are plain functions DataFrame -> DataFrame;
sources and sinks live in ``wattage.sources``, the incremental load in
``wattage.streaming`` and the scheduled jobs in ``wattage.plans.jobs``.
Call ``wattage.session.configure(spark)`` once per session.
"""

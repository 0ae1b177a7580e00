"""Daily engagement analytics over a feed log and a message log, on Spark.

Every operator takes DataFrames and returns a lazy DataFrame; only the writers
and the job in ``daygauge.plans`` start Spark jobs.
"""

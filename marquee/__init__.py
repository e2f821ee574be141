"""Marquee: recommender-system data operators as Spark DataFrame and Spark ML jobs.

Column functions take and return ``Column``; table operators take and return
``DataFrame``.  Nothing holds a global session and nothing but bounded model
state or one-row aggregates ever reaches the driver.
"""

__version__ = "0.1.0"

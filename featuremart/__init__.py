"""featuremart: monthly feature tables and data-quality checks on Spark.

Every operator is a composition of DataFrame / SQL expressions so that
Catalyst can prune, push down and plan the whole job; no Python UDFs.
"""

__version__ = "0.1.0"

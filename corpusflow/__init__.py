"""corpusflow: labelled-text analytics, classifier building and log monitoring on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built on the public
PySpark DataFrame / SQL / MLlib / Structured Streaming API.
"""

__version__ = "0.1.0"

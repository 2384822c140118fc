"""English stop-word list.

The default is Spark's own list (``StopWordsRemover.loadDefaultStopWords``),
read from the MLlib jar that ships with PySpark so it is available without a
running JVM (the DuckDB oracles need it too).  It differs from the list of the
Python library the reference used; pass ``stop_words=`` to use another list.
"""
from __future__ import annotations

import functools
import glob
import os
import zipfile


@functools.lru_cache(maxsize=None)
def english() -> tuple[str, ...]:
    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    if jars:
        with zipfile.ZipFile(jars[0]) as z:
            words = z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode().split()
        return tuple(dict.fromkeys(w.strip() for w in words if w.strip()))
    from pyspark.ml.feature import StopWordsRemover  # needs a running JVM
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))

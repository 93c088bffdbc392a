"""quire: a Spark-native corpus engine for language-model data.

Every public operator takes and returns DataFrames, so it composes with
``DataFrame.transform`` and stays inside Catalyst's plan.  Sub-packages:

* ``quire.sources``    readers and writers (lines, records, articles, pages, URL lists)
* ``quire.functions``  column expressions (Unicode strip, HTML text, array helpers)
* ``quire.operators``  tokenize, chunking, batching, metrics, sampling, runs, crawl
* ``quire.plans``      the registered queries and their DuckDB twins
* ``quire.streaming``  Structured Streaming forms of the page / record jobs
"""

__version__ = "0.1.0"

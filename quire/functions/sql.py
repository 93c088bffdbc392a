"""SQL surface: table functions for SQL users.

``chunk_ids(ids, len)`` yields the fixed windows of an id array (stride ``len``, short
tail dropped) as rows ``(chunk_idx, start, input_ids)``.  It is a SQL function, which the optimizer
inlines: a lateral call is one generator in the JVM, as ``quire.operators.chunking.chunk`` is for DataFrame users.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

CHUNK_IDS = """
CREATE OR REPLACE TEMPORARY FUNCTION chunk_ids(ids ARRAY<INT>, len INT)
RETURNS TABLE(chunk_idx INT, start INT, input_ids ARRAY<INT>)
RETURN SELECT i, CAST(i * len AS INT), slice(ids, i * len + 1, len)
       FROM (SELECT explode(CASE WHEN len > 0 AND size(ids) >= len THEN sequence(0, CAST(size(ids) DIV len AS INT) - 1)
                                 ELSE CAST(array() AS ARRAY<INT>) END) AS i)
"""


def register_sql_functions(spark: SparkSession) -> None:
    spark.sql(CHUNK_IDS)

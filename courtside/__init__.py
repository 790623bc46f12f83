"""courtside: Spark-native text, link and box-score analytics.

Every public operator is a ``DataFrame -> DataFrame`` function built from
built-in Spark SQL expressions, so Catalyst plans it and it scales with the
cluster.  Sub-packages:

* ``sources``   - table scans, seed lists, fixed parameter lists
* ``functions`` - Column expressions (HTML text, tokenizer, URLs, cells, stemmer)
* ``operators`` - relational operators (last-N, top-k, zip, index, TF-IDF, graph)
* ``sinks``     - CSV / Parquet writers
* ``plans``     - the registered end-to-end queries over the driver tables
* ``streaming`` - Structured Streaming drivers for the incremental operators
"""

__version__ = "0.1.0"

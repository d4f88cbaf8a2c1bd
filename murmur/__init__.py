"""murmur: comment analytics on Spark DataFrames.

Layers (all DataFrame / Spark SQL jobs over every video at once):

* ``murmur.sources``   – payload flattening, fixture adapters, table I/O
* ``murmur.functions`` – column expressions: text clean-up, ontology, labels
* ``murmur.operators`` – curation, language id, annotation, n-grams, latest-row
* ``murmur.plans``     – report views, dashboard metrics, query catalog, SQL oracles
* ``murmur.streaming`` – incremental curation / annotation with Structured Streaming
"""

__version__ = "0.1.0"

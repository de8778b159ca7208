"""Affinis: implicit-feedback recommendation and interaction analytics on Spark.

Every operator takes DataFrames and returns DataFrames. Subpackages:

* ``functions``  - column expressions (titles, genres, vectors, labels)
* ``operators``  - table-to-table operators (filters, splits, ids, models, metrics)
* ``sources``    - readers and writers (ratings, logs, bundles, runs)
* ``plans``      - compositions: preparation, training, the query catalog
* ``streaming``  - Structured Streaming jobs over the request log
"""

__version__ = "0.1.0"

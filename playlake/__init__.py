"""playlake — media-engagement lakehouse on Spark.

Layers: landing JSON envelopes -> Bronze (flattened records) -> Silver (typed,
validated, latest record per key) -> Gold star schema (dim_media, dim_visitor,
fact_media_engagement) -> report DataFrames. Every step is a lazy DataFrame
built from Spark built-in expressions; nothing is collected before a final,
small result.

Sub-packages:

* ``sources``   schemas, landing scan/sink, layer scan/sink, path handling,
                and the mapping of the driver's ``events`` table to raw records.
* ``functions`` column expressions (parsing, classification, formatting).
* ``operators`` DataFrame -> DataFrame transforms (Bronze, Silver, Gold, reports).
* ``plans``     multi-step jobs: layer runs, full refresh, incremental load,
                and the query catalog used by ``__spark_entry__``.
* ``streaming`` landing -> Bronze as an ``availableNow`` file stream.
"""

__version__ = "0.1.0"

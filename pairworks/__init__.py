"""pairworks: question/SQL pair preparation on Spark.

Every operator takes and returns DataFrames.  The packages are

* ``functions``  column expressions (text, hashing, similarity, SQL functions)
* ``sources``    catalogs, samples, JSON lines in and out
* ``operators``  profiling, relationships, pairs, masking, tasks, usage
* ``streaming``  the incremental form of pair ingestion
* ``plans``      the registered queries over the driver tables
"""

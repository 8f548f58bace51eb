"""Match statistics on Spark: raw match documents in, statistics tables out.

The layers are plain ``DataFrame -> DataFrame`` functions:

* ``sources``    landing files, tables, published intermediate tables
* ``operators``  document status, game extraction, statistics, upsert, feed
* ``functions``  column expressions (tiers, scores, labels, positions)
* ``plans``      the daily run and the tables behind each dashboard panel
* ``streaming``  the same run over a stream of landed files
* ``workload``   the mapping from the benchmark tables and the registered queries
"""

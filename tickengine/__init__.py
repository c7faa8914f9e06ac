"""Market-tick analytics on Spark tables and streams.

Subpackages:

* ``functions`` - column expressions (prices, times, clustering values)
* ``operators`` - ``DataFrame -> DataFrame`` steps for batch and streaming
* ``sources``   - reading and writing ticks, tables and messages
* ``streaming`` - streaming sources, sinks and jobs
* ``plans``     - multi-step jobs: maintenance, replay, registered queries
"""

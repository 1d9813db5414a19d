"""shelfstar: retail analytics as Spark DataFrame operators.

Layers, each a set of plain functions ``DataFrame -> DataFrame``:

* ``functions``  scalar expressions returning a ``Column``
* ``operators``  cleaning, deduplication, checks, joins, keys, facts, measures, row and column rules
* ``sources``    delimited files, layer tables, event streams
* ``streaming``  incremental event refinement
* ``plans``      report queries and layer jobs composed from the operators
"""

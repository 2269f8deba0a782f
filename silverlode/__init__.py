"""silverlode: a PySpark-native medallion (bronze / silver / gold) analytics engine.

Transforms are plain ``DataFrame -> DataFrame`` functions, so Catalyst sees one
declarative plan per table.  Only ``sources``, ``sinks``, ``streaming`` and
``plans.jobs`` touch storage.
"""

"""Keyed-panel analytics on PySpark.

Every operator takes and returns a ``DataFrame``; every scalar function takes
and returns a ``Column``.  Nothing is collected to the driver except results
whose size is bounded by the schema or by a declared list.
"""

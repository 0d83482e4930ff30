"""stratiform: layered (bronze / silver / gold) table jobs written as Spark DataFrame functions.

Every public operator is a ``DataFrame -> DataFrame`` function built from
built-in Spark expressions, so Catalyst plans, prunes and distributes it.
"""

__version__ = "0.1.0"

"""Job-posting preparation, embedding and matching on Spark.

Operators are lazy ``DataFrame -> DataFrame`` functions built from column
expressions; see the subpackages ``sources``, ``functions``, ``operators``,
``plans`` and ``streaming``.
"""

"""lodgeframe: short-term-rental data work as Spark DataFrames.

``functions``  Column -> Column helpers (native expressions only)
``operators``  DataFrame -> DataFrame steps, chainable with ``df.transform``
``sources``    readers, schemas, record sinks
``plans``      the three gold tables and their reports
``streaming``  the gold tables published from a stream
``queries``    the registered checks on the driver tables
"""

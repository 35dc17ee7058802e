"""plumeline: methane-pixel and facility-report analytics as Spark DataFrame jobs.

Layout:
  functions/  column expressions (rounding, distance, legal-location geocoding, file-name tags)
  sources/    readers and writers (monthly battery CSV, swath granules, bronze tables)
  operators/  DataFrame -> DataFrame operators (filters, distance joins, aggregates, ids, audits, medallion)
  plans/      fixture views and the named query catalogue used by ``__spark_entry__``
  streaming/  incremental (availableNow) ingest of a landing folder
"""

__version__ = "0.1.0"

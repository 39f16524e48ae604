"""carespark: clinical claims analytics as Spark DataFrame operators.

Layers
------
- ``functions``  scalar Column expressions (try-casts, date keys, masks, text).
- ``sources``    CSV landing with lineage/rejects, the Parquet driver binding,
                 legacy wide-claim sources.
- ``operators``  reusable distributed operators (skew-safe ordered scans,
                 exact percentiles, surrogate keys, idempotent appends, data
                 quality checks, calendar generator).
- ``plans``      star-schema build, analytical marts, features, risk model,
                 care-gap narrative, governance.
- ``streaming``  Structured Streaming ingest with exactly-once fact appends.
"""

__version__ = "0.1.0"

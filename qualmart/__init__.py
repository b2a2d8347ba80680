"""qualmart: facility-quality scorecards as Spark DataFrame plans.

Layers (each a set of lazy DataFrame transformations):

* ``sources``   – feed schemas, CSV landing reader, derived test feeds, versioned table store
* ``functions`` – column expressions (case-insensitive keys, cleaning, calendar attributes)
* ``operators`` – reusable relational building blocks (benchmarks, upsert, surrogate keys,
  calendar, ranking, data-quality checks)
* ``plans``     – the staging / star refresh, the measure layer and the report shapes
* ``streaming`` – micro-batch driver that runs the keyed refresh as feed files land
"""

__all__ = ["session"]

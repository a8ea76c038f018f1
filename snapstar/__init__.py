"""snapstar: a Spark-native warehouse for periodic snapshots of rental listings.

Layers, from input to answer:

* ``contracts``  column names, types and rules every layer agrees on
* ``sources``    CSV snapshots: discovery, typed reading, fit checks
* ``functions``  Column expressions (cleaning, calendar, text comparison)
* ``operators``  reusable DataFrame steps (latest row per key, numbered keys, ...)
* ``plans``      history archive, dimensions, facts, profiles, gates, analyses
"""

"""Retail pricing analytics expressed as Spark DataFrame functions.

Sub-packages:

* ``functions`` - Column -> Column expressions (cleaning, casting, keys, dates)
* ``sources``   - raw scans, seeds, result sinks
* ``operators`` - reusable DataFrame operators (dedup, joins, upsert, history, checks)
* ``plans``     - the models built from them (layers, marts, features, pricing)
"""

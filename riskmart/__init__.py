"""riskmart: transaction-risk analytics as Spark DataFrame jobs.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``    - CSV / Parquet readers and writers, the events adapter, case-note store
* ``functions``  - column expressions (time features, rounding, text, answer parsing)
* ``operators``  - staging, quality, enrichment, marts, scoring, investigation,
                   case notes, reporting
* ``plans``      - the layer pipeline, the batch investigation plan, the query catalog
"""

__version__ = "0.1.0"

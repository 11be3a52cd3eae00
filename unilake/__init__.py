"""unilake: unify source systems with different schemas on Spark.

Layers: raw (versioned landed snapshots) -> staging (declarative column
mappings) -> intermediate (unified models with surrogate keys), gated by
dataset-scale data tests and kept fresh by batch or streaming refresh.
"""

__version__ = "0.1.0"

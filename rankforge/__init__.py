"""rankforge: chart-rank classification analytics on Spark.

Every operator is a function ``DataFrame -> DataFrame`` (usable with
``df.transform``) built from the DataFrame API, Spark SQL expressions and
``pyspark.ml`` stages. Nothing is collected to the driver except bounded
metadata (range bounds, per-partition counts, model coefficients).
"""

from rankforge.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]

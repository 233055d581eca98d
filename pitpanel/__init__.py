"""pitpanel: point-in-time financial research panels on Spark.

Every public function takes and returns DataFrames; the work is declared
with the DataFrame API so Catalyst, AQE and whole-stage codegen decide the
physical plan.
"""

from pitpanel.session import get_spark, work_dir

__all__ = ["get_spark", "work_dir"]

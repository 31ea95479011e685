"""quarry: lakehouse data jobs expressed as Spark DataFrame plans.

Every public function takes DataFrames (or a SparkSession plus paths) and
returns DataFrames; planning and execution stay with Catalyst / Tungsten.
"""

from quarry.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]

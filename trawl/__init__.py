"""trawl: crawl, index and search web pages with Spark DataFrames.

Every operator is a DataFrame -> DataFrame (or Column -> Column) function built
from native Spark SQL expressions, so Catalyst plans, prunes and pushes down the
whole job and nothing runs row-by-row in Python on the hot path.
"""

from trawl.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]

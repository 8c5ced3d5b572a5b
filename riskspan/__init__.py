"""riskspan: vulnerability-risk analytics as Spark DataFrame jobs.

Every public operator takes DataFrames (or Columns) and returns DataFrames
(or Columns).  Work is expressed with built-in Spark SQL expressions so that
Catalyst can push filters into scans, prune columns and keep whole-stage
codegen; Python runs inside tasks only where an operator cannot be written
with built-ins (Shapiro-Wilk, the inner sweep of the exact Kendall count).
"""

from riskspan.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
__version__ = "0.1.0"

"""codeledger: portfolio analytics for source-code repositories on PySpark.

Every public function takes and returns DataFrames (or Columns); nothing runs
until the caller writes or collects.  See README.md for the module map.
"""

from codeledger.session import build_session, checkpointed

__all__ = ["build_session", "checkpointed"]

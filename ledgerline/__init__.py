"""ledgerline: a subscription-analytics warehouse on Spark DataFrames.

Raw tables -> staging -> Data Vault -> SCD2 snapshots -> dimensions ->
facts -> marts, metrics and data-quality checks; every table is a pure
function from DataFrames (plus an ``as_of`` date and a ``load_ts``) to a
DataFrame.  See README.md.
"""

from .config import Config

__all__ = ["Config"]

"""DuckDB SQL for every registered analysis, used as the correctness oracle.

The queries are written from the definitions of the analyses, in another way
than the Spark plans (numbered months joined to those before them, lists,
EXISTS counts), so that each checks the other.  Months are DATEs, money is
output as DOUBLE, printed ratios are rounded through DECIMAL(38,12), and
thresholds are compared on exact numbers.  Each string starts with the
mapping of the test tables onto the model.
"""

import tidemark.oracle.matching_sql  # noqa: F401 - adds its queries
from tidemark.oracle.sql import ORACLE_SQL, model_sql

__all__ = ["ORACLE_SQL", "model_sql"]

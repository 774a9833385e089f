"""Fixed test clock and report ranges used by the registered queries.

The reference reads CURRENT_DATE; every operator here takes ``as_of``
explicitly.  These dates fit the driver data (events span 2024-01-01..30).
"""

import datetime as _dt

AS_OF_30D = _dt.date(2024, 2, 10)     # 30-day metrics: window starts 2024-01-11
AS_OF_ETL = _dt.date(2024, 1, 16)     # nightly ETL: processes 2024-01-15
REPORT_START = _dt.date(2024, 1, 5)
REPORT_END = _dt.date(2024, 1, 25)
ETL_PROCESSED_AT = _dt.datetime(2024, 1, 16, 2, 0, 0)
RETENTION_AS_OF = _dt.date(2024, 2, 28)   # 3-month raw horizon: keeps >= 2023-11-28
RETENTION_CURATED_AS_OF = _dt.date(2025, 1, 28)   # 13 months: keeps >= 2023-12-28
RETENTION_CUTOFF = _dt.date(2023, 11, 28)


def minus(d: _dt.date, days: int) -> _dt.date:
    return d - _dt.timedelta(days=days)

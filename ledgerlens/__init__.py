"""ledgerlens: payments retention analytics as plain PySpark DataFrame functions.

Layout
------
``functions``  column-expression builders (labels, dates, money, status rules)
``operators``  DataFrame -> DataFrame operators (pricing, densify, horizons,
               status, report, rate gaps, landing clean-up, flag log, audits)
``sources``    readers/writers and the test-data views
``plans``      composed query plans (retention report, jobs) and the SQL oracle
``streaming``  Structured Streaming form of the flag log
"""

__version__ = "0.1.0"

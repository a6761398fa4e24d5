"""scoreloom: company scoring from prices, news and filings, as Spark DataFrame transforms.

Every transform takes and returns DataFrames and receives its clock as an argument, so a run can
be repeated.  Timestamps are TIMESTAMP_NTZ values in UTC: no result depends on the session zone.
"""

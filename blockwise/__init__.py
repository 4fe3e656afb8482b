"""blockwise: urban-records analytics as Spark DataFrame operators.

Sub-packages
------------
functions   pure ``Column`` builders (house numbers, dates, codes, slope,
            polygon tests, projection, tokens, line formats)
operators   ``DataFrame -> DataFrame`` building blocks (segment sides,
            equi+range attribution, yearly counts, grid-cell zone join,
            keyword matching, top-k)
sources     readers for the raw files and for the driver's parquet tables
sinks       CSV / text writers
plans       the four end-to-end jobs and the query catalogue
streaming   the zone count as a Structured Streaming query
"""

from blockwise.session import get_session

__all__ = ["get_session"]

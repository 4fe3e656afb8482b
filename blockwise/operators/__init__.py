"""DataFrame -> DataFrame operators: range join, segments, trend, zones, keywords, ranking."""

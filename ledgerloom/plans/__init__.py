"""Report definitions as data, report parameters, and the list of queries."""

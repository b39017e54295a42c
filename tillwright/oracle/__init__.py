"""The same questions asked in SQL, for an independent engine to answer.

The SQL follows the plain definition of each report (row-level joins, no pre-aggregation), so that a
mistake in a rewritten Spark plan cannot hide in an equally rewritten check. All sums of money are
divided as whole cents, which makes every rounding exact.
"""

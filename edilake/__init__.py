"""Bulk EDI (ANSI X12) analytics as Spark DataFrame jobs."""

"""Scorebook: nested match documents to analysis-ready tables, as Spark DataFrame operators."""

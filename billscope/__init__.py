"""Reporting and marketing-analytics jobs written as Spark DataFrame plans."""

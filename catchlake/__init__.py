"""Catch analytics as Spark DataFrame operators."""

"""Declarative table pipelines built from lazy PySpark DataFrame operators."""

"""Layered analytical tables on plain PySpark: conform, validate, model, measure."""

"""Vaccine-safety report analytics expressed as Spark DataFrame plans."""

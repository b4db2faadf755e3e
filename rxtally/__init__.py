"""Prescribing statistics as Spark jobs: extract, aggregate, publish, model."""

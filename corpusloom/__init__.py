"""Corpusloom: a PySpark engine that turns documents and their metadata into training datasets."""

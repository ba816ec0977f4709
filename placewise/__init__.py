"""Batch recommendations for local businesses, expressed as Spark jobs.

Every public function takes and returns DataFrames (or fitted Spark ML models);
nothing is collected except vocabularies whose size is checked first.
"""

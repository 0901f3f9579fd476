"""galley: a restaurant-analytics warehouse on PySpark.

Source drops are checked against a contract, staged, modelled as a star schema with a
versioned store dimension, audited and reported. Every stage is a function from
DataFrames to DataFrames; Catalyst plans the work and ``sources.store`` writes the
results.
"""

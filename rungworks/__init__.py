"""Competitive-ladder analytics as Spark jobs.

Every public function takes DataFrames and returns DataFrames.  Nothing reads a
clock: the moment a job runs "as of" is an argument.
"""

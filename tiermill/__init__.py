"""tiermill: bronze / silver / gold jobs as plain DataFrame operators on Spark.

Every operator takes DataFrames and parameters and returns a DataFrame. No operator opens a session
or prints; the few that run a Spark job while building a plan (a size check, a written intermediate)
say so in their docstring.
"""

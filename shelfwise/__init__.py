"""Product-catalogue analytics as Spark DataFrame operators.

Every operator takes DataFrames plus parameters and returns a lazy DataFrame;
only estimators, iterative clustering and sinks run jobs on their own.
"""

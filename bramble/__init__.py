"""bramble: review-table analytics as Spark DataFrame / Spark ML operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a Spark ML fit)
that takes column names as arguments.  Heavy work stays on the executors;
statistics that a later step needs as a constant are folded into the plan as
scalar subqueries or size-checked joins instead of being collected.
"""

__version__ = "0.1.0"

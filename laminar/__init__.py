"""laminar: layered (bronze / silver / gold) analytics written as Spark DataFrame plans.

Every public function takes and returns DataFrames; nothing is collected to the
driver except a handful of bounded scalars (quality verdicts, row counts for logs).
"""

__version__ = "0.1.0"

"""corvid: batch and streaming data operators expressed with the PySpark DataFrame API.

Every operator is a plain function ``DataFrame(s) + params -> DataFrame``. Planning,
partitioning and execution are left to Catalyst/AQE; operators only add structure where
the declarative plan would otherwise concentrate a hot key in one task.
"""

__all__ = ["session", "sources", "operators", "functions", "plans", "streaming"]

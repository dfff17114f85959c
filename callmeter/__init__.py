"""API metering and tiered billing as Spark jobs.

Access-log records go through five steps, each a function from DataFrame to
DataFrame: parse, archive, meter, price, roll up.  The streaming form in
``callmeter.streaming`` runs the same functions once per micro-batch.
"""

from callmeter.settings import Settings

__all__ = ["Settings"]

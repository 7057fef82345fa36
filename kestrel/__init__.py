"""kestrel: PySpark pipelines for K-12 student data.

Every pipeline is a plain Python function ``f(inputs, params) -> DataFrame`` built
from Catalyst-visible column expressions (no Python UDFs), so Spark plans,
prunes, pushes down and distributes the whole job.
"""

__version__ = "0.1.0"

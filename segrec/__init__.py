"""segrec: segment-based recommendation as Spark DataFrame plans.

Sub-packages: ``sources`` (readers), ``sinks`` (writers), ``functions`` (column
expressions), ``operators`` (DataFrame -> DataFrame steps), ``plans`` (composite runs and
the CLI). The workload is batch; there is no streaming part.
"""

from segrec.config import RunConfig  # noqa: F401

__version__ = "0.1.0"

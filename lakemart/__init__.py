"""lakemart: a retail lakehouse pipeline and analytics library on Spark DataFrames.

Layers: raw sources -> bronze (tagged, append-only) -> silver (deduplicated,
validated, with quarantine) -> gold star schema -> business metrics and
grouped BI measures.  Every operator is a DataFrame -> DataFrame function built
from Spark's native expressions; only ``lakemart.plans.pipeline`` writes.
"""

__version__ = "0.1.0"

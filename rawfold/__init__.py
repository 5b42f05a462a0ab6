"""rawfold: turn raw, append-only e-commerce connector tables into staging datasets with Spark.

Every dataset follows one recipe, expressed with the DataFrame API so Catalyst and AQE plan it:

    discover relations -> union by name -> explode nested arrays -> convert / default / rename
    -> left join daily FX rates -> keep the newest batch per key -> lineage columns -> merge

The subpackages map onto that recipe:

* ``sources``    - relation discovery, union by name, incremental watermark, merge/upsert, table layout
* ``functions``  - column expressions (lineage, time zones, typed defaults, nested extraction)
* ``operators``  - DataFrame -> DataFrame transforms (keep-latest, explode chains, FX join, checks)
* ``plans``      - the dataset specs and the builder/runner that turns a spec into a plan
* ``streaming``  - the same recipe driven by Structured Streaming (``foreachBatch``, available-now)
"""

from rawfold.config import Settings

__all__ = ["Settings"]
__version__ = "0.1.0"

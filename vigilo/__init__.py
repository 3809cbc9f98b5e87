"""vigilo: drug-safety analytics expressed as Spark DataFrame plans.

Layers: ``sources`` (delimited-file ingestion and contracts), ``functions``
(Column -> Column scalars), ``operators`` (DataFrame -> DataFrame building
blocks: dedupe, skew-safe joins, flag pivots, calendar), ``plans`` (silver
cleaners, star-schema dimensions and facts, measures, the end-to-end
pipeline), ``streaming`` (file-incremental ingestion with Structured
Streaming) and ``sinks`` (table writes, audit columns, run log).
"""

__version__ = "0.1.0"

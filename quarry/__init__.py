"""quarry: regional activity marts built from Spark DataFrame / SQL operators.

Layers: ``sources`` (readers and test-table adapters), ``functions``
(Column -> Column helpers), ``operators`` (filters, joins, aggregates,
rankings, nearest-place join, data-quality checks), ``plans`` (bronze /
silver / gold models and the whole run), ``sinks`` (stamping and table
writes), ``streaming`` (incremental file loads).
"""

__all__ = ["__version__"]
__version__ = "0.1.0"

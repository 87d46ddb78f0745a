"""shopscope: retail order analytics on Spark.

Raw shop tables are cleaned, joined into one line-item fact, checked for key and
value constraints, and summarised into revenue, retention, forecast and
finding marts. Every operator is a lazy ``DataFrame -> DataFrame`` function.
Actions happen only where they are part of the design: the table writes of
the warehouse build and of publishing, the bounded size probes behind
broadcasts (``operators.sizing``), and the reliable checkpoints of the forecast
cascade stages and of ``ranking.global_row_number``.
"""

__version__ = "0.1.0"

"""docforge: document corpus preparation on Spark.

Operators are DataFrame -> DataFrame functions (``docforge.operators``) and
Column -> Column expressions (``docforge.functions``); ``docforge.sources``
and ``docforge.sinks`` read and write files and tables;
``docforge.streaming`` holds the incremental forms; ``docforge.plans``
composes them into end-to-end jobs.
"""

__version__ = "0.1.0"

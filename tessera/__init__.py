"""tessera: corpus and sample preparation as Spark jobs.

Subpackages: ``functions`` (column expressions), ``sources``/``sinks`` (I/O),
``operators`` (DataFrame transforms), ``plans`` (composite jobs),
``streaming`` (the same jobs on readStream).
"""

__version__ = "0.1.0"

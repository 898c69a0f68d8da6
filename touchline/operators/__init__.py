"""The jobs, as ``DataFrame -> DataFrame`` functions: ``sales``, ``matches``,
``passes``, ``teams``, ``players``, ``colors`` and ``classify``."""

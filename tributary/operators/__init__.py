"""DataFrame operators, one module per area of the survey's inventory:
``cumulative`` and ``scd`` (dimensions), ``facts``, ``joins`` (layout and
skew), ``sessions``, ``patterns``, ``experiments`` and ``monitoring`` (pipeline
checks)."""

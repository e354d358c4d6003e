"""visitflow: visit-log analytics as Spark DataFrame jobs.

Modules: ``sources`` (scans, adapters, sinks), ``functions`` (column
expressions and predicates), ``operators`` (sessions, categories, funnel,
sampling, area), ``streaming`` (ad clicks), ``plans`` (jobs, query registry,
SQL twins).
"""

__version__ = "0.1.0"

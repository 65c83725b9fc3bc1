"""dimstar: a Spark-native dimensional warehouse and KPI engine.

Subpackages: ``sources`` (CSV entities, driver tables), ``functions``
(fixed values and column expressions), ``operators`` (validation, states,
dimensions, fact, KPIs, checks), ``plans`` (the load, the registered queries
and their oracle SQL), ``streaming`` (empty by design).
"""

"""Card-transaction risk analytics as Spark DataFrame operators.

``functions`` holds Column -> Column expressions, ``sources`` readers and sinks,
``operators`` DataFrame -> DataFrame operators, ``plans`` the end-to-end jobs.
"""

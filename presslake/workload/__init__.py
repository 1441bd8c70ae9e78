"""Test workload: article archives derived from the driver tables.

``fixtures`` turns the tables into raw feeds, pages and URL lists inside Spark,
``queries`` runs the operators on them, and ``oracles`` states the expected
results as SQL over the base columns, without ever looking at the derived JSON
or HTML.
"""

"""Training-data operators: thirteen corpus operators, their queries and their SQL.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds the queries only if it is present.
"""

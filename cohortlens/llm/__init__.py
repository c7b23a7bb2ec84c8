"""Training-data operators: ten corpus jobs, their queries and their SQL.

Nothing else in the library imports this subpackage.
"""

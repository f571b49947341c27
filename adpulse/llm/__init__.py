"""Training-data pipeline operators (ten operators and their queries).

Nothing else in the library imports this subpackage. Each operator is a module
with its own general interface; :mod:`adpulse.llm.queries` registers one thin
query per operator.
"""

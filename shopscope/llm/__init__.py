"""Training-data pipeline operators.

Each module holds one operator with its own general interface; ``queries.py``
wraps them as the thin registered ``opN_<name>`` queries. Nothing else in the
library imports this subpackage.
"""

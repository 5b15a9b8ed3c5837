"""Training-data operators: each module holds one operator with its own general interface.

Nothing outside this folder imports it. ``queries`` registers one query an operator.
"""

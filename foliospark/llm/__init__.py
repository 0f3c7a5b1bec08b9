"""Training-data operators: one module per operator.

Nothing outside this subpackage imports it; it can be deleted whole.
"""

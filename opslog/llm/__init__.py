"""Operators for preparing training text at corpus scale.

One module per operator; ``queries`` registers one query per operator. Nothing
outside this subpackage imports it.
"""

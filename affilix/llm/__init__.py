"""Operators of a training-data pipeline: cleaning, de-duplicating, labelling and mixing texts.

Nothing outside this subpackage imports it. ``queries`` registers one query per operator.
"""

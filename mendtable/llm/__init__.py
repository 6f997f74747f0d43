"""Operators that prepare text for training language models, each a set of Spark jobs.

Every operator takes a table with an id and a text column and returns a table; ids may be null or
repeat, texts may be null, empty or very long, and other columns never matter. ``queries`` registers
one query per operator.
"""

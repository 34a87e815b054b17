"""Training-data operators: mixing, sharding, dedup, decontamination, rules, extraction.

Each module holds one operator with its general interface; ``queries``
registers one thin digest query per operator.  Nothing outside this
subpackage imports it.
"""

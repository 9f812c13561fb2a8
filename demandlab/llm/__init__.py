"""Training-data operators: dedup, scoring, mixing, decontamination, packing.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator over the driver's tables.
"""

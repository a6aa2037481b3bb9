"""Training-data operators (quality, near duplicates, decontamination, mixing, ...).

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries only when it is present.
"""

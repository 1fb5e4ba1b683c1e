"""Training-data operators: ten corpus operators, their queries and the helpers they share.

Nothing else in the library imports this package; the entry module registers its queries when it is there.
"""

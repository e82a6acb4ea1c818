"""Nothing here: the operator inventory holds no streaming operator.

All operators are plain DataFrame transformations; those without a global
sort or an action can be applied inside ``foreachBatch`` as they are.
"""

"""Training-data operators: sharding, tokenising, filtering and near-duplicate search.

Nothing outside this folder imports it, but for the guarded hook in the
driver's entry module and the pipeline module beside that.
"""

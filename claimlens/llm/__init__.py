"""Training-data operators: near-duplicate removal, nearest neighbours, packing, sharding, quality rules,
tokenisation, language-model scoring and text classifiers, as Spark jobs.

Nothing outside this subpackage imports it.
"""

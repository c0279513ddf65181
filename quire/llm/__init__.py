"""Training-data operators: dedup, classifiers, joins, media, archives, tokenizing."""

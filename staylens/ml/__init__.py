"""Vector features, classifiers, clustering and their evaluation on Spark ML."""

"""DataFrame -> DataFrame operators: cleaning, features, matrix, clustering, silhouette, baskets, rules, profiles."""

"""DataFrame operators: ids, preferences, products, rankings, documents, queries."""

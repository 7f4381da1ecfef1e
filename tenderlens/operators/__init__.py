"""DataFrame -> DataFrame operators: cleaning, selection, features, models, summaries."""

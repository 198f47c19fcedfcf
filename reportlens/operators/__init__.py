"""DataFrame to DataFrame operators: curation, analyses, allocation, quality, trends."""

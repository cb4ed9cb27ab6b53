"""DataFrame operators: curation, analyses, ad-hoc queries, gates, sampling, scoring."""

"""DataFrame operators: contracts, envelopes, mapping, cleaning, dedupe, gates, summaries."""

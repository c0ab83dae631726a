"""Named queries, their SQL oracles, and the batch pipeline."""

"""End-to-end compositions (mining levels, one-pass and hybrid segmentation) and the query catalog."""

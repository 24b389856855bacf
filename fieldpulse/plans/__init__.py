"""Multi-step jobs over the lake: one micro-batch, a full rebuild, the reports."""

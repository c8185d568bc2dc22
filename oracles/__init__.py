"""SQL oracles, written independently of the DataFrame code."""

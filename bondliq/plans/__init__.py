"""Composite jobs: market metrics (C2-C4), liquidity table (C5), daily run."""

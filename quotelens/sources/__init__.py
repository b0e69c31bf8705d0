"""quotelens.sources."""

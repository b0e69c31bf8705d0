"""quotelens.streaming."""

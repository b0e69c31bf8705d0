"""quotelens.functions."""

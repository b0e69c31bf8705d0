"""quotelens.operators."""

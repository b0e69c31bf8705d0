"""quotelens.plans."""

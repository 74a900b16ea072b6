"""Table contracts and the plans that fill them."""

"""Training-data operators: ten corpus components, each usable on its own."""
